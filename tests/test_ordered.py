"""Distributed index and lags agree with single-partition window functions,
including a key that holds most rows and chunks much smaller than it."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.ordered import with_lags, with_series_index


def _data(spark):
    rnd = random.Random(7)
    rows = [("HOT", float(i), rnd.random()) for i in range(400)]
    rows += [("COLD", float(rnd.randint(0, 10_000)), rnd.random()) for _ in range(37)]
    return spark.createDataFrame(rows, "k string, o double, v double")


def test_index_equals_row_number(spark):
    df = _data(spark)
    got = with_series_index(df, "k", "o", "t", partitions=17)
    want = df.withColumn("t", F.row_number().over(Window.partitionBy("k").orderBy("o", "v")) - 1)
    a = {(r.k, r.o, r.v): r.t for r in got.collect()}
    b = {(r.k, r.o, r.v): r.t for r in want.collect()}
    # ties in o may be numbered either way: compare the multiset of (k, o, t)
    assert sorted((k, o, t) for (k, o, _), t in a.items()) == sorted((k, o, t) for (k, o, _), t in b.items())
    assert sorted(a.values()) == sorted(b.values())


def test_lags_equal_window_lag(spark):
    df = with_series_index(_data(spark), "k", "o", "t", partitions=17)
    got = with_lags(df, "k", "t", ["v"], [1, 3, 20], chunk_rows=16)
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("*", *[F.lag("v", k).over(w).alias(f"v_lag{k}") for k in (1, 3, 20)])
    key = lambda r: (r.k, r.t)
    assert sorted(got.collect(), key=key) == sorted(want.select(*got.columns).collect(), key=key)


def test_no_row_is_dropped_and_nulls_sort_last(spark):
    rows = [("A", 2.0, 1.0), ("A", None, 2.0), ("A", 1.0, 3.0), (None, 5.0, 4.0), (None, None, 5.0), (None, 4.0, None)]
    df = spark.createDataFrame(rows, "k string, o double, v double")
    got = sorted(((r.k or "", r.t, r.o) for r in with_series_index(df, "k", "o", "t", partitions=3).collect()))
    assert got == [("", 0, 4.0), ("", 1, 5.0), ("", 2, None), ("A", 0, 1.0), ("A", 1, 2.0), ("A", 2, None)]


def test_partitions_stay_even_under_outliers_and_ties(spark):
    n = 20_000
    spread = spark.range(n).selectExpr("'K' AS k", "IF(id = 0, 1e12, id) AS o", "id AS v")
    ties = spark.range(n).selectExpr("'K' AS k", "IF(id < 18000, 1.0, id) AS o", "id AS v")
    for df in (spread, ties):
        got = with_series_index(df, "k", "o", "t", partitions=20)
        assert got.agg(F.countDistinct("t"), F.min("t"), F.max("t")).first()[:] == (n, 0, n - 1)
        import glob
        import os
        from marketlens.session import shared_dir
        base = shared_dir(spark).removeprefix("file:") + "/marketlens/"
        last = max(glob.glob(base + "series-[0-9a-f]*"), key=os.path.getmtime)
        sizes = [r["count"] for r in spark.read.parquet(last).groupBy(F.shiftright("_at", 33)).count().collect()]
        assert max(sizes) <= 3 * n / 20


def test_totals_ride_on_the_index(spark):
    got = with_series_index(_data(spark), "k", "o", "t", partitions=9, totals={
        "_n": (F.count("v"), F.sum), "_hi": (F.max("o"), F.max)}).select("k", "_n", "_hi").distinct().collect()
    assert sorted((r.k, r._n) for r in got) == [("COLD", 37), ("HOT", 400)]
    assert {r.k: r._hi for r in got}["HOT"] == 399.0
