"""Paths and literal feed frames of the tests."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def feed_rows(spark, rows):
    """Literal long-feed frame from (seq, 'YYYY-mm-dd HH:MM:SS[.f]', currency, feed, cost, quantity)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "seq long, ts string, currency string, feed string, cost double, quantity double")
    ts = F.to_timestamp("ts")
    return df.select("seq", ts.alias("ts"), F.unix_micros(ts).alias("us"), "currency", "feed", "cost", "quantity")
