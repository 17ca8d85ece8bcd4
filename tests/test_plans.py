"""Physical-plan guards over every registered batch query: no cartesian
products or nested-loop joins, no sort-based aggregation, and top-N windows
limited map-side."""

import pytest

import __spark_entry__ as E
from feed_help import SF001
from marketlens.plans.registry import REGISTRY

BATCH = sorted(k for k in REGISTRY if not k.startswith("stream_") and k != "run_cycle")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_or_sort_aggregate(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_top_n_limited_before_the_shuffle(spark):
    plan = _plan(E.queries()["recent_trades"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_one_symbol_query_prunes_partitions(spark):
    plan = _plan(E.queries()["tv_one_symbol"](spark, SF001))
    assert "PartitionFilters: [isnotnull(currency" in plan and "(currency#" in plan
    assert "BTCUSDT" in plan.split("PartitionFilters")[1].split("]")[0]


TABLE_READERS = ("tv_min_time", "tv_symbols", "tv_rename_drop", "tv_one_symbol", "buy_sell_pressure", "candle_body",
                 "corr_matrix", "hour_grid", "hour_grid_days")


@pytest.mark.parametrize("name", [k for k in TABLE_READERS if k in REGISTRY])
def test_analysis_reads_the_stored_table(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "FileScan orc" in plan and "ExistingRDD" not in plan


def test_scan_of_the_stored_table_is_pruned(spark):
    plan = _plan(E.queries()["tv_min_time"](spark, SF001))
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert read.count(":") == 1 and "current_time" in read


def test_queries_leave_the_callers_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = E.queries()["price_ohlc"](spark, SF001).count()
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo" and got
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
