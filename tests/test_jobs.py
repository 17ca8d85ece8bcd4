"""The consumer job end to end on a replayed feed, then compaction and an
analysis of the resulting table."""

import uuid

from pyspark.sql import functions as F

from feed_help import SF001
from marketlens import config as C
from marketlens.__main__ import build_parser
from marketlens.operators import series as X
from marketlens.plans.trade_volume import trade_volume_onepass
from marketlens.session import scratch_path
from marketlens.sinks.orc import compact
from marketlens.sources.fixtures import feed_table
from marketlens.streaming import jobs
from marketlens.streaming.source import write_time_slices


def test_consume_event_mode_then_compact_and_analyze(spark):
    src = scratch_path(spark, "job_in")
    feed = feed_table(spark, SF001)
    write_time_slices(feed, src)
    table = f"{C.DATABASE}.tv_job_{uuid.uuid4().hex[:8]}"
    q = jobs.consume(spark, jobs.feed_from_files(spark, src, 5), table=table,
                     checkpoint=scratch_path(spark, "job_ckpt"), available_now=True)
    q.awaitTermination()
    got = compact(spark, table)
    batch = trade_volume_onepass(feed)
    assert 0 < got.count() <= batch.count()
    assert got.select("currency", "current_time").exceptAll(batch.select("currency", "current_time")).count() == 0
    assert X.acf(got, nlags=2).count() == got.select("currency").distinct().count() * 3


def test_parity_mode_one_row_per_symbol_and_batch(spark):
    src = scratch_path(spark, "job_in_p")
    write_time_slices(feed_table(spark, SF001), src)
    table = f"{C.DATABASE}.tv_par_{uuid.uuid4().hex[:8]}"
    q = jobs.consume(spark, jobs.feed_from_files(spark, src, 10), table=table, mode="parity",
                     checkpoint=scratch_path(spark, "job_ckpt_p"), available_now=True)
    q.awaitTermination()
    t = spark.table(table)
    assert t.count() > 0
    assert t.groupBy("currency", "current_time").count().where(F.col("count") > 1).count() == 0


def test_cli_parses_every_command():
    p = build_parser()
    assert p.parse_args(["consume", "--checkpoint", "c", "--bootstrap", "b"]).mode == "event"
    assert p.parse_args(["cycle", "--checkpoint", "c", "--source-path", "s"]).minutes == C.RUN_CYCLE_MINUTES
    assert p.parse_args(["cycle", "--checkpoint", "c", "--source-path", "s", "--repeat", "--stop-file", "f"]).repeat
    assert p.parse_args(["split", "--checkpoint", "c", "--source-path", "s", "--archive", "a", "--late", "l"]).late == "l"
    assert p.parse_args(["correct", "--archive", "a", "--late", "l", "--closed-before", "2024-01-01"]).step == "1 day"
    assert p.parse_args(["compact"]).table.endswith(C.TRADE_VOLUME_TABLE)
    assert p.parse_args(["analyze", "adf", "--out", "o"]).what == "adf"


def test_undecodable_records_are_kept(spark):
    from marketlens.sources import kafka as KF
    rows = [("PRICE_BTC_USD", 0, 1, b'{"cost": 1.5, "current_time": 1700000000000}'), ("BID_ETHBTC", 0, 2, b"{broken"), ("BID_X", 1, 3, b"null?")]
    records = spark.createDataFrame(rows, "topic string, partition int, offset long, value binary").withColumn(
        "timestamp", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    d = KF.decode(KF.route(records))
    feed = KF.as_feed(d).collect()
    assert [(r.feed, r.currency, r.cost) for r in feed] == [("PRICE", "BTC_USD", 1.5)]
    bad = KF.undecodable(d).collect()
    assert sorted((r.topic, r.partition, r.offset, r.value) for r in bad) == [("BID_ETHBTC", 0, 2, "{broken"), ("BID_X", 1, 3, "null?")]


def test_quarantine_query_writes_every_bad_record(spark, tmp_path):
    from marketlens.sources import kafka as KF
    src, out = str(tmp_path / "in"), str(tmp_path / "bad")
    spark.createDataFrame([("BID_A", 0, 7, b"{x"), ("BID_A", 0, 8, b'{"cost": 2}')], "topic string, partition int, offset long, value binary") \
        .withColumn("timestamp", F.to_timestamp(F.lit("2024-01-01 00:00:00"))).write.parquet(src)
    stream = spark.readStream.schema("topic string, partition int, offset long, value binary, timestamp timestamp").parquet(src)
    q = jobs.write_quarantine(KF.undecodable(KF.decode(KF.route(stream))), out, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination()
    assert [r.offset for r in spark.read.parquet(out).collect()] == [7]


def test_compaction_leaves_clean_partitions(spark):
    from marketlens.sinks.orc import append_partitioned, create_database
    create_database(spark, C.DATABASE)
    table = f"{C.DATABASE}.tv_dirty_{uuid.uuid4().hex[:8]}"
    day = lambda d, n: spark.range(n).select("id", F.lit(d).cast("date").alias("current_day"), F.lit("A").alias("currency"))
    append_partitioned(day("2024-01-01", 3), table=table)
    append_partitioned(day("2024-01-02", 2), table=table)
    append_partitioned(day("2024-01-02", 4), table=table)
    def files():
        rows = spark.table(table).select("current_day", F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {str(d): {r.f for r in rows if r.current_day == d} for d in {r.current_day for r in rows}}
    before = files()
    assert compact(spark, table).count() == 9
    after = files()
    assert after["2024-01-01"] == before["2024-01-01"] and len(before["2024-01-02"]) == 2 and len(after["2024-01-02"]) == 1
