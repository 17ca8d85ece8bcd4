"""Time grids and bucket arithmetic.

* :func:`hour_grid` — hourly points from the hour of the earliest instant to
  the hour of an end instant (default: the latest instant in the data).
* :func:`bucket_bounds` — the bucket enclosing each instant (half-open, as
  ``window`` gives it), the strict variant that has no bucket for an instant
  exactly on a boundary, and the next boundary.
* :func:`candle_grid` — every bucket start of every day a symbol trades, for
  gap-filled candles; generated per symbol, never by a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def interval(step: str) -> Column:
    """``'15 minutes'`` -> INTERVAL literal column."""
    return F.expr(f"INTERVAL {step}")


def hour_grid(df: DataFrame, time_col: str, end_col: str | None = None,
              whole_days: bool = False, out: str = "hour") -> DataFrame:
    """Hourly series from ``date_trunc('hour', min(time_col))`` to
    ``date_trunc('hour', max(end_col or time_col))``, both ends included.

    ``whole_days=True`` keeps only whole days of the span plus the start
    point (``days * 24 + 1`` points), the count the reference script prints.
    """
    ttype = df.schema[time_col].dataType          # keep the input's timestamp flavour
    bounds = df.agg(
        F.date_trunc("hour", F.min(time_col)).cast(ttype).alias("_start"),
        F.date_trunc("hour", F.max(end_col or time_col)).cast(ttype).alias("_stop"),
    )
    stop = F.col("_stop")
    if whole_days:
        secs = (F.unix_seconds(F.col("_stop").cast("timestamp"))
                - F.unix_seconds(F.col("_start").cast("timestamp")))
        days = F.floor(secs / 86400).cast("int")
        stop = F.col("_start") + F.make_dt_interval(days, F.lit(0), F.lit(0), F.lit(0))
    return bounds.select(F.explode(F.sequence("_start", stop, interval("1 hour"))).alias(out))


def bucket_bounds(df: DataFrame, ts: str = "ts", step: str = "15 minutes") -> DataFrame:
    """Add ``bucket_start``/``bucket_end`` (half-open ``[start, end)``),
    ``strict_start``/``strict_end`` (NULL when the instant is exactly on a
    boundary) and ``next_start`` (the boundary after the bucket)."""
    w = F.window(ts, step)
    start, end = w.start, w.end
    on_edge = F.col(ts) == start
    return df.select(
        "*",
        start.alias("bucket_start"),
        end.alias("bucket_end"),
        F.when(~on_edge, start).alias("strict_start"),
        F.when(~on_edge, end).alias("strict_end"),
        (end).alias("next_start"),
    )


def grid_days(df: DataFrame, step: str, ts: str = "ts", key: str = "currency") -> DataFrame:
    """``(key, day, steps)``: the bucket starts of width ``step`` of every day from a key's first to its last; buckets
    are counted from the first day's start and end with the last day.

    Days are dealt out before their steps are made: months first, then the days of a month, so
    no array is longer than a day has steps (or a span has months), and a long history is spread over tasks."""
    span = df.groupBy(key).agg(
        F.date_trunc("day", F.min(ts)).alias("_d0"),
        F.date_trunc("day", F.max(ts)).alias("_d1"),
    )
    flavour = df.schema[ts].dataType
    one_day, width = interval("1 day"), F.expr(f"INTERVAL {step}")
    months = span.select(key, "_d0", "_d1", F.explode(F.sequence(F.date_trunc("month", "_d0"), F.col("_d1"), interval("1 month"))).alias("_month"))
    days = months.select(key, "_d0", "_d1", F.explode(F.sequence(
        F.greatest(F.col("_month"), F.col("_d0")), F.least(F.col("_month") + interval("1 month") - one_day, F.col("_d1")), one_day)).alias("day"))
    days = days.repartition(F.col(key), F.col("day"))

    def seconds(c):
        return F.unix_seconds(c.cast("timestamp"))

    epoch = F.to_timestamp(F.lit("1970-01-01 00:00:00"))
    size = F.unix_seconds(epoch + width) - F.unix_seconds(epoch)
    nth = F.ceil((seconds(F.col("day")) - seconds(F.col("_d0"))) / size)
    first = F.col("_d0") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (nth * size).cast("decimal(18,6)"))
    last = F.least(F.col("day") + one_day - F.expr("INTERVAL 1 SECOND"), F.col("_d1") + one_day - width)
    steps = F.when(first <= last, F.sequence(first, last, width))
    return days.select(key, F.col("day").cast(flavour).alias("day"), steps.alias("steps")).where("steps IS NOT NULL")


def candle_grid(df: DataFrame, step: str, ts: str = "ts", key: str = "currency") -> DataFrame:
    """All bucket starts of width ``step`` covering each day in which a key
    has data, one row per ``(key, bucket_start)``.

    The grid is derived per key from its own first and last day, so its size
    follows the data's time span; there is no cross join with a symbol list.
    """
    return grid_days(df, step, ts, key).select(key, F.explode("steps").alias("bucket_start"))
