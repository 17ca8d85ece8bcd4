"""Edge cases and equivalences of the wide trade_volume row."""

import pytest
from pyspark.sql import functions as F

from feed_help import SF001, SF01, feed_rows
from marketlens.plans.trade_volume import trade_volume_fold, trade_volume_onepass
from marketlens.schemas import TRADE_VOLUME_SCHEMA
from marketlens.sources.fixtures import feed_table


def _all_feeds(cur="ETHBTC", day="2024-01-01"):
    return [
        (1, f"{day} 00:00:01", cur, "PRICE", 10.0, None),
        (2, f"{day} 00:00:02", cur, "PRICE", 12.0, None),
        (3, f"{day} 00:00:03", cur, "BID", 5.0, 1.0),
        (4, f"{day} 00:00:04", cur, "ASK", 6.0, 2.0),
        (5, f"{day} 00:00:05", cur, "SELL", 7.0, 3.0),
        (6, f"{day} 00:00:06", cur, "BUY", 8.0, 4.0),
    ]


@pytest.mark.parametrize("plan", [trade_volume_onepass, trade_volume_fold])
def test_single_row_groups_have_null_spread(spark, plan):
    out = plan(feed_rows(spark, _all_feeds())).collect()
    assert len(out) == 1
    r = out[0]
    assert r.first_cost == 10.0 and r.last_cost == 12.0 and r.max_cost == 12.0 and r.min_cost == 10.0
    assert r.bid_avg_cost == 5.0 and r.bid_std_cost is None and r.bid_var_cost is None
    assert r.sell_sum_quantity == 3.0


@pytest.mark.parametrize("plan", [trade_volume_onepass, trade_volume_fold])
def test_book_levels_distinct_trades_not(spark, plan):
    rows = _all_feeds() + [
        (10, "2024-01-01 00:01:00", "ETHBTC", "BID", 5.0, 1.0),
        (11, "2024-01-01 00:02:00", "ETHBTC", "BID", 5.0, 1.0),
        (12, "2024-01-01 00:01:00", "ETHBTC", "SELL", 7.0, 3.0),
        (13, "2024-01-01 00:02:00", "ETHBTC", "SELL", 7.0, 3.0),
    ]
    r = plan(feed_rows(spark, rows)).collect()[0]
    assert r.bid_sum_quantity == 1.0          # same level three times: once
    assert r.sell_sum_quantity == 9.0         # same trade three times: three times
    assert r.sell_var_cost == 0.0


@pytest.mark.parametrize("plan", [trade_volume_onepass, trade_volume_fold])
def test_symbol_missing_a_feed_is_dropped(spark, plan):
    rows = _all_feeds("ETHBTC") + [r for r in _all_feeds("XMRBTC") if r[3] != "BUY"]
    out = plan(feed_rows(spark, [(i, *r[1:]) for i, r in enumerate(rows)])).collect()
    assert [r.currency for r in out] == ["ETHBTC"]


def test_keep_partial_groups_when_asked(spark):
    rows = [r for r in _all_feeds("XMRBTC") if r[3] != "BUY"]
    out = trade_volume_onepass(feed_rows(spark, rows), require_all=False).collect()
    assert len(out) == 1 and out[0].buy_avg_cost is None


@pytest.mark.parametrize("plan", [trade_volume_onepass, trade_volume_fold])
def test_empty_input_declared_schema(spark, plan):
    out = plan(feed_rows(spark, []))
    assert out.count() == 0
    assert [f.name for f in out.schema.fields] == [f.name for f in TRADE_VOLUME_SCHEMA.fields]


def test_first_last_ties_broken_by_seq(spark):
    rows = _all_feeds() + [(0, "2024-01-01 00:00:01", "ETHBTC", "PRICE", 99.0, None),
                           (9, "2024-01-01 00:00:02", "ETHBTC", "PRICE", 77.0, None)]
    r = trade_volume_onepass(feed_rows(spark, rows)).collect()[0]
    assert r.first_cost == 99.0 and r.last_cost == 77.0


@pytest.mark.parametrize("sf,rows", [(SF001, 8), (SF01, 322)])
def test_onepass_equals_fold(spark, sf, rows):
    f = feed_table(spark, sf)
    a = trade_volume_onepass(f, decimals=8)
    b = trade_volume_fold(f, decimals=8)
    assert a.count() == rows
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_onepass_plan_has_no_join_and_hash_aggregates(spark):
    plan = trade_volume_onepass(feed_table(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "SortAggregate" not in plan
    assert "HashAggregate" in plan


def test_scan_prunes_columns(spark):
    df = feed_table(spark, SF001).select("currency", "cost")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the columns the projection needs are read
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double,props:string>" in plan \
        or "user_id" in plan and "event_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_onepass_reads_the_table_once(spark):
    plan = trade_volume_onepass(feed_table(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Union" not in plan and "Join" not in plan


def test_hot_symbol_holding_most_rows(spark):
    """Two thirds of all rows on one symbol: the one-pass plan (map-side
    partials on a hot key) still equals the fold, row for row."""
    f = feed_table(spark, SF01).withColumn(
        "currency", F.when(F.col("seq") % 3 != 0, F.lit("BTCUSDT")).otherwise(F.col("currency")))
    a = trade_volume_onepass(f, decimals=8)
    b = trade_volume_fold(f, decimals=8)
    hot = a.where(F.col("currency") == "BTCUSDT").count()
    assert hot > 0 and a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
