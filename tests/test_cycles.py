"""Timed cycles under a supervisor, and late rows with their corrections."""

import datetime as dt
import uuid

import pytest
from feed_help import SF001
from pyspark.sql import functions as F

from marketlens import config as C
from marketlens.plans.trade_volume import trade_volume_onepass
from marketlens.session import scratch_path
from marketlens.sinks import orc as O
from marketlens.sources.fixtures import feed_table
from marketlens.streaming import cycle as Y
from marketlens.streaming import jobs
from marketlens.streaming import late as L
from marketlens.streaming.source import read_feed_stream, write_time_slices


def fresh_table(spark):
    O.create_database(spark, C.DATABASE)
    return f"{C.DATABASE}.y_{uuid.uuid4().hex[:8]}"


def closed(feed, table_rows, delay_hours=1):
    end = feed.agg(F.max(F.col("ts").cast("timestamp_ntz"))).first()[0] - dt.timedelta(hours=delay_hours)
    return table_rows.where(F.col("current_time") + F.expr("INTERVAL 1 DAY") <= F.lit(end))


def same(got, want):
    cols = ["currency", "current_time", "first_cost", "max_cost", "bid_sum_quantity", "sell_sum_quantity"]
    key = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in df.select(*cols).collect()), key=str)
    assert key(got) == key(want)


def test_two_timed_cycles_one_killed_before_compaction(spark, monkeypatch):
    feed = feed_table(spark, SF001)
    mid = feed.agg(F.percentile_approx("us", 0.5)).first()[0]
    src, ckpt, table = scratch_path(spark, "y_in"), scratch_path(spark, "y_ckpt"), fresh_table(spark)
    go = lambda **kw: Y.supervise(spark, lambda: read_feed_stream(spark, src, 50), table=table, checkpoint=ckpt, minutes=0.3,
                                  interval_seconds=1, cycles=1, **kw)
    write_time_slices(feed.where(F.col("us") < mid), src)
    compact = Y.compact

    def killed(*a, **kw):
        raise KeyboardInterrupt("killed between stop and compaction")

    monkeypatch.setattr(Y, "compact", killed)
    with pytest.raises(KeyboardInterrupt):
        go()
    log = Y.CycleLog(spark, f"{ckpt}/_cycles")
    assert log.now() == (0, "compacting")
    ran = []
    monkeypatch.setattr(Y, "compact", lambda *a, **kw: ran.append("compact") or compact(*a, **kw))
    real = Y.run_stream
    monkeypatch.setattr(Y, "run_stream", lambda *a, **kw: ran.append("run") or real(*a, **kw))
    assert go() == 1 and ran == ["compact"]             # the interrupted cycle is finished, its stream is not run again
    write_time_slices(feed.where(F.col("us") >= mid), src)
    assert go() == 2 and ran == ["compact", "run", "compact"]
    same(spark.table(table), closed(feed, trade_volume_onepass(feed)))
    per = spark.table(table).select("current_day", "currency", F.input_file_name().alias("f")).distinct().groupBy("current_day", "currency").count()
    assert per.agg(F.max("count")).first()[0] == 1


def test_supervisor_stops_when_told(spark):
    src, ckpt, table = scratch_path(spark, "y_in"), scratch_path(spark, "y_ckpt"), fresh_table(spark)
    write_time_slices(feed_table(spark, SF001).limit(50), src)
    stop = scratch_path(spark, "y_stop")
    Y.Files(spark, stop).write(stop)
    assert Y.supervise(spark, lambda: read_feed_stream(spark, src, 50), table=table, checkpoint=ckpt, minutes=60, stop_file=stop) == 0


def deliver(spark, feed, src):
    """On-time rows of the first half, then late ones of its first days, then the second half with a few very late rows."""
    mid = feed.agg(F.percentile_approx("us", 0.5)).first()[0]
    h = F.pmod(F.xxhash64("seq"), F.lit(10))
    first, second = F.col("us") < mid, F.coalesce(F.col("us") >= mid, F.lit(True))
    return [feed.where(first & (h >= 2)), feed.where(first & (h == 1)), feed.where(second), feed.where(first & (h == 0))]


def test_late_rows_are_kept_and_windows_corrected(spark):
    feed = feed_table(spark, SF001)
    nowhen = feed.limit(3).withColumn("ts", F.lit(None).cast("timestamp"))       # no instant: never late, in no window
    feed = feed.unionByName(nowhen.withColumn("us", F.lit(None).cast("long")))
    src, archive, late, ckpt = (scratch_path(spark, f"late_{x}") for x in ("in", "archive", "side", "ckpt"))
    table = fresh_table(spark)
    for part in deliver(spark, feed, src):
        write_time_slices(part, src)
        L.split_late(read_feed_stream(spark, src, 3), archive=archive, late=late, checkpoint=f"{ckpt}/split", available_now=True).awaitTermination()
        q = jobs.consume(spark, read_feed_stream(spark, archive, 4), table=table, checkpoint=f"{ckpt}/main", available_now=True)
        q.awaitTermination()
        dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
        assert dropped == 0                      # the split has them all
    n_late = L._feed(spark, late).count()
    assert n_late > 20 and L._feed(spark, archive).count() + n_late == feed.count()
    assert L._feed(spark, archive).unionByName(L._feed(spark, late)).exceptAll(feed.select(*[f.name for f in L.FEED_SCHEMA.fields])).count() == 0
    want = closed(feed, trade_volume_onepass(feed))
    end = feed.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    fix = lambda: L.correct_windows(spark, archive=archive, late=late, table=table, closed_before=end)
    assert fix() > 5
    same(spark.table(table), want)
    assert fix() > 5                             # again: the same result
    same(spark.table(table), want)


def test_interrupted_correction_is_finished(spark, monkeypatch):
    from marketlens.sinks import commit as K
    feed = feed_table(spark, SF001)
    src, archive, late, ckpt = (scratch_path(spark, f"late_{x}") for x in ("in", "archive", "side", "ckpt"))
    table = fresh_table(spark)
    parts = deliver(spark, feed, src)
    for part in (parts[0], parts[1], parts[2], parts[3]):
        write_time_slices(part, src)
    L.split_late(read_feed_stream(spark, src, 3), archive=archive, late=late, checkpoint=f"{ckpt}/split", available_now=True).awaitTermination()
    jobs.consume(spark, read_feed_stream(spark, archive, 9), table=table, checkpoint=f"{ckpt}/main", available_now=True).awaitTermination()
    end = feed.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    real, calls = K.Files.rename, [0]

    def fail(self, *a):
        calls[0] += 1
        if calls[0] == 3:
            raise RuntimeError("crash")
        return real(self, *a)

    monkeypatch.setattr(K.Files, "rename", fail)
    with pytest.raises(RuntimeError):
        L.correct_windows(spark, archive=archive, late=late, table=table, closed_before=end)
    monkeypatch.setattr(K.Files, "rename", real)
    assert O.recover_compaction(spark, table) == 1
    same(spark.table(table), closed(feed, trade_volume_onepass(feed)))
