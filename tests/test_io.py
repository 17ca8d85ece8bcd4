"""Sinks and sources: managed ORC table, compaction, partition pruning,
quarantine, trade routing, order books."""

import uuid

from pyspark.sql import functions as F

from feed_help import SF001
from marketlens import config as C
from marketlens.operators import feeds as FD
from marketlens.plans.tv import saved_trade_volume
from marketlens.schemas import ORDER_SCHEMA, quarantine_split
from marketlens.sinks import orc as O


def test_managed_table_append_compact_and_prune(spark):
    O.create_database(spark, C.DATABASE)
    table = f"{C.DATABASE}.tv_{uuid.uuid4().hex[:8]}"
    tv = saved_trade_volume(spark, SF001)
    for part in O.hash_slices(tv, 3):
        O.append_partitioned(part.repartition(4), table=table)
    O.append_partitioned(tv, table=table)   # a second batch for every partition: 2 files each
    meta = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").first()
    assert meta.data_type == "MANAGED"
    cols = spark.table(table).columns
    assert cols[-2:] == ["current_day", "currency"]
    before_rows = sorted(map(tuple, spark.table(table).collect()))
    before_files = O.file_count(spark, table)
    O.compact(spark, table)
    spark.catalog.refreshTable(table)
    after_rows = sorted(map(tuple, spark.table(table).collect()))
    assert after_rows == before_rows                     # nothing dropped, nothing deduplicated
    partitions = spark.table(table).select("current_day", "currency").distinct().count()
    assert O.file_count(spark, table) == partitions
    assert before_files == 2 * partitions
    plan = spark.table(table).where(F.col("currency") == "BTCUSDT")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "BTCUSDT" in plan


def test_quarantine_split_reasons(spark):
    df = spark.createDataFrame([("A", "1.5", "2"), ("B", "x", "2"), ("C", "1.0", None)],
                               "Currency string, Cost string, Quantity string")
    good, bad = quarantine_split(df, ORDER_SCHEMA)
    assert [(r.currency, r.cost, r.quantity) for r in good.collect()] == [("A", 1.5, 2.0)]
    reasons = {r.Currency: r.reason for r in bad.collect()}
    assert reasons == {"B": "bad_type:cost", "C": "missing:quantity"}


def test_route_trades_null_flag_gets_no_feed(spark):
    raw = spark.createDataFrame([(1, "A", "1.0", "0.1", True), (2, "A", "1.0", "0.1", False),
                                 (3, "A", "1.0", "0.1", None)],
                                "seq long, currency string, price string, qty string, is_buyer_maker boolean")
    got = {r.seq: r.feed for r in FD.route_trades(raw).collect()}
    assert got == {1: "SELL", 2: "BUY", 3: None}


def test_book_explode_keeps_duplicates_and_top_n(spark):
    books = spark.createDataFrame(
        [("s", "A", [("10", "1"), ("10", "1"), ("9", "2")], [("11", "1"), ("12", "1")])],
        "snapshot string, currency string, bids array<struct<price:string,qty:string>>, "
        "asks array<struct<price:string,qty:string>>")
    lv = FD.book_explode(books)
    assert lv.count() == 5
    top = FD.book_top_n(lv, 1).collect()
    assert sorted((r.side, r.price) for r in top) == [("ASK", 11.0), ("BID", 10.0)]


def test_filter_symbols_list_and_frame(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "currency string")
    many = ["A", "C"] + [f"Z{i}" for i in range(2000)]
    for symbols in (many, spark.createDataFrame([(x,) for x in many], "s string")):
        assert sorted(r.currency for r in FD.filter_symbols(df, symbols).collect()) == ["A", "C"]
    assert FD.parse_symbols(" A, B,,C ") == ["A", "B", "C"]


def test_in_time_range_and_latest_ties(spark):
    from feed_help import feed_rows
    rows = feed_rows(spark, [
        (1, "2024-01-01 00:00:00", "A", "PRICE", 1.0, None),
        (2, "2024-01-01 00:00:05", "A", "PRICE", 2.0, None),
        (3, "2024-01-01 00:00:10", "A", "PRICE", 3.0, None),
        (4, "2024-01-01 00:00:10", "A", "PRICE", 4.0, None),   # same instant, later seq
        (5, "2024-01-01 00:00:11", "B", "SELL", 5.0, 1.0),
    ])
    end = F.to_timestamp(F.lit("2024-01-01 00:00:10"))
    got = sorted(r.seq for r in FD.in_time_range(rows, end, "5 seconds").collect())
    assert got == [2, 3, 4]
    latest = {(r.currency, r.feed): r.cost for r in FD.latest_by_key(rows).collect()}
    assert latest == {("A", "PRICE"): 4.0, ("B", "SELL"): 5.0}


def test_poll_limit_keeps_oldest(spark):
    from feed_help import feed_rows
    rows = feed_rows(spark, [(i, f"2024-01-01 00:00:0{i}", "A", "SELL", float(i), 1.0) for i in range(6)])
    got = sorted(r.seq for r in FD.poll_limited(rows, "10 seconds", limit=2).collect())
    assert got == [0, 1]


def test_symbol_filter_is_pushed_into_the_scan(spark):
    from marketlens.session import scratch_path
    path = scratch_path(spark, "t_push")
    spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "currency string, cost double") \
        .write.parquet(path)
    df = FD.filter_symbols(spark.read.parquet(path), ["A", "C"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(currency, [A,C])]" in plan
    assert sorted(r.currency for r in df.collect()) == ["A", "C"]
