"""Scalar edge cases: buckets, epoch millis, float narrowing, JSON decode,
hour grid, inverse normal."""

import datetime as dt

import pytest
from statistics import NormalDist

from pyspark.sql import functions as F

from marketlens.functions.normal import norm_ppf
from marketlens.functions.scalars import epoch_millis_to_ts, narrow_to_float, to_double
from marketlens.functions.timegrid import bucket_bounds, candle_grid, grid_days, hour_grid
from marketlens.sources import kafka as KF


def test_bucket_boundary_half_open_and_strict(spark):
    df = spark.createDataFrame([("2024-01-01 00:15:00",), ("2024-01-01 00:20:00",)], "s string") \
        .select(F.to_timestamp("s").alias("ts"))
    rows = {r.ts.minute: r for r in bucket_bounds(df, "ts", "15 minutes").collect()}
    on, inside = rows[15], rows[20]
    assert on.bucket_start.minute == 15 and on.bucket_end.minute == 30
    assert on.strict_start is None and on.strict_end is None
    assert inside.strict_start.minute == 15 and inside.next_start.minute == 30


def test_epoch_millis(spark):
    r = spark.createDataFrame([(1704067200123,)], "m long").select(
        epoch_millis_to_ts("m").cast("timestamp_ntz").alias("t")).first()
    assert r.t == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_float_narrowing_and_bad_numbers(spark):
    r = spark.createDataFrame([("0.1", "abc")], "q string, bad string").select(
        narrow_to_float("q").alias("n"), to_double("q").alias("d"), to_double("bad").alias("b")).first()
    assert r.n == 0.10000000149011612 and r.d == 0.1 and r.b is None


def test_hour_grid_full_and_whole_days(spark):
    df = spark.createDataFrame([("2024-01-01 00:30:00",), ("2024-01-03 12:10:00",)], "s string") \
        .select(F.to_timestamp("s").alias("ts"))
    assert hour_grid(df, "ts").count() == 61
    assert hour_grid(df, "ts", whole_days=True).count() == 49


def test_candle_grid_per_symbol(spark):
    df = spark.createDataFrame([("A", "2024-01-01 05:00:00"), ("A", "2024-01-02 05:00:00"),
                                ("B", "2024-01-02 01:00:00")], "currency string, s string") \
        .select("currency", F.to_timestamp("s").alias("ts"))
    counts = {r.currency: r["count"] for r in candle_grid(df, "4 hours").groupBy("currency").count().collect()}
    assert counts == {"A": 12, "B": 6}


def test_minute_grid_over_twenty_years_has_short_arrays(spark):
    df = spark.createDataFrame([("A", "2004-03-17 05:00:00"), ("A", "2024-02-29 05:00:00")], "currency string, s string") \
        .select("currency", F.to_timestamp("s").alias("ts"))
    days = grid_days(df, "1 minute")
    n = (dt.date(2024, 2, 29) - dt.date(2004, 3, 17)).days + 1
    got = days.agg(F.count("*").alias("n"), F.max(F.size("steps")).alias("longest"), F.sum(F.size("steps")).alias("all")).first()
    assert (got.n, got.longest, got["all"]) == (n, 1440, n * 1440)
    edges = candle_grid(df, "1 minute").agg(F.min("bucket_start"), F.max("bucket_start")).first()
    assert [str(x) for x in edges] == ["2004-03-17 00:00:00", "2024-02-29 23:59:00"]


@pytest.mark.parametrize("step,seconds", [("7 minutes", 420), ("5 hours", 18000), ("36 hours", 129600), ("1 day", 86400), ("3 days", 259200)])
def test_grid_of_any_step_runs_on_over_midnight(spark, step, seconds):
    df = spark.createDataFrame([("A", "2024-01-30 05:00:00"), ("A", "2024-02-03 23:00:00"), ("B", "2024-01-31 00:00:00")], "currency string, s string") \
        .select("currency", F.to_timestamp("s").cast("timestamp_ntz").alias("ts"))
    got = {}
    for r in candle_grid(df, step).collect():
        got.setdefault(r.currency, []).append(r.bucket_start)
    for k, first, last in (("A", dt.datetime(2024, 1, 30), dt.datetime(2024, 2, 4)), ("B", dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 1))):
        want, t = [], first
        while t + dt.timedelta(seconds=seconds) <= last:
            want.append(t)
            t += dt.timedelta(seconds=seconds)
        assert sorted(got.get(k, [])) == want


def test_json_decode_cases(spark):
    values = [
        '{"currency":"ETHBTC","cost":1.5,"quantity":2.0}',        # good
        '{"currency":"ETHBTC","cost":1.5}',                        # absent field
        '{"currency":"ETHBTC","cost":"x","quantity":2.0}',         # wrong type
        '{"currency":"ETHBTC","cost":1.5,"quantity":2.0,"z":1}',   # unknown field
        'not json',                                                # not JSON
        '{"currency":"ETHBTC","cost":2.0,"current_time":1704067200123}',
    ]
    recs = spark.createDataFrame([(v, "BID_ETHBTC", i) for i, v in enumerate(values)],
                                 "v string, topic string, offset long") \
        .select(F.col("v").cast("binary").alias("value"), "topic", "offset")
    out = {r.offset: r for r in KF.decode(KF.route(recs)).collect()}
    assert out[0].cost == 1.5 and out[0].quantity == 2.0 and out[0]._corrupt_record is None
    assert out[1].quantity is None and out[1]._corrupt_record is None
    assert out[2]._corrupt_record is not None
    assert out[2].currency == "ETHBTC" and out[2].quantity == 2.0 and out[2].cost is None
    assert out[3].quantity == 2.0 and out[3]._corrupt_record is None
    assert out[4]._corrupt_record == "not json" and out[4].currency is None
    assert out[5].current_time.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_topic_route_filters_unknown_families(spark):
    recs = spark.createDataFrame([("PRICE_ETHBTC",), ("OTHER_ETHBTC",), ("SELL_XMRBTC",)], "topic string")
    got = sorted((r.feed, r.topic_currency) for r in KF.route(recs).collect())
    assert got == [("PRICE", "ETHBTC"), ("SELL", "XMRBTC")]


def test_norm_ppf_matches_reference_implementation(spark):
    ps = [1e-12, 0.001, 0.02, 0.3, 0.5, 0.77, 0.975, 0.999999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.z for r in df.select(norm_ppf(F.col("p")).alias("z")).collect()]
    want = [NormalDist().inv_cdf(p) for p in ps]
    assert all(abs(a - b) < 1e-12 * max(1, abs(b)) for a, b in zip(got, want))


def test_topic_keeps_separators_of_the_symbol(spark):
    from marketlens.functions.scalars import topic_currency, topic_feed
    df = spark.createDataFrame([("PRICE_BTC_USD",), ("BID_ETHBTC",), ("PRICE",), ("ASK_",)], "topic string")
    got = [(r[0], r[1]) for r in df.select(topic_feed("topic"), topic_currency("topic")).collect()]
    assert got == [("PRICE", "BTC_USD"), ("BID", "ETHBTC"), ("PRICE", ""), ("ASK", "")]
