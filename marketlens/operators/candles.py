"""Candles: open/close/high/low of the PRICE feed over event-time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.timegrid import candle_grid
from . import stats as S


def candles(feed: DataFrame, step: str, feed_name: str = C.PRICE) -> DataFrame:
    """OHLC per ``(window(ts, step), currency)`` plus the tick count."""
    rows = feed.where(F.col("feed") == feed_name)
    return (S.with_bucket(rows, step)
            .groupBy(*S.GROUP_KEYS)
            .agg(*S.ohlc_exprs(), F.count(F.lit(1)).alias("ticks")))


def candles_filled(feed: DataFrame, step: str, feed_name: str = C.PRICE) -> DataFrame:
    """Candles on the full grid of each symbol's trading days; empty buckets
    get NULL prices and ``ticks = 0``."""
    rows = feed.where(F.col("feed") == feed_name)
    grid = candle_grid(rows, step)
    c = S.finish(candles(feed, step, feed_name)).withColumnRenamed("current_time", "bucket_start")
    grid = grid.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))
    out = grid.join(c, ["currency", "bucket_start"], "left")
    return out.select(
        "currency", F.col("bucket_start").alias("current_time"),
        "first_cost", "last_cost", "max_cost", "min_cost",
        F.coalesce("ticks", F.lit(0)).alias("ticks"))
