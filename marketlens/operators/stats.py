"""Per-feed summaries (open/close/high/low; seven order statistics), the
USING-join and the N-way fold join of summaries.

All summaries group by ``(window, currency)``: ``window`` is the event-time
bucket struct produced by ``F.window`` (tumbling), which is also the key a
streaming state store can evict by watermark.  Every aggregate here is a
declarative Spark aggregate with a partial (map-side) phase, so a hot symbol
is collapsed before the shuffle and the exchange carries at most one row per
(task, group).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

GROUP_KEYS = ("window", "currency")


def with_bucket(feed: DataFrame, step: str = "1 day", ts: str = "ts") -> DataFrame:
    """Add the tumbling event-time bucket ``window`` (half-open [start, end))."""
    return feed.withColumn("window", F.window(ts, step))


def _masked(col: str, cond: Column | None) -> Column:
    return F.col(col) if cond is None else F.when(cond, F.col(col))


# (us, seq) packed into one order-preserving decimal(38,0):
#   key = us * 10^20 + (seq + 2^63)
# seq + 2^63 lies in [0, 2^64) < 10^20, so the key sorts exactly like the pair
# for |us| < 10^17.  A decimal is a mutable aggregation-buffer type, so
# min_by/max_by on it stay in HashAggregate; a struct ordering would force a
# sort-based aggregate over every input row.
_SEQ_SHIFT = 2 ** 63
_US_SCALE = 10 ** 20


def order_key(us: str = "us", seq: str = "seq") -> Column:
    """Arrival order of a row as one comparable decimal (see above)."""
    return (F.col(us).cast("decimal(18,0)") * F.lit(str(_US_SCALE)).cast("decimal(21,0)")
            + (F.col(seq).cast("decimal(20,0)") + F.lit(str(_SEQ_SHIFT)).cast("decimal(20,0)")))


def ohlc_exprs(cond: Column | None = None) -> list[Column]:
    """first/last/max/min of ``cost``; first and last by ``(us, seq)``.

    ``min_by``/``max_by`` on :func:`order_key` pick the earliest/latest row
    deterministically (``seq`` breaks ties on equal instants), aggregate
    partially map-side, and work on streams where row ordering functions do
    not.  Rows outside ``cond`` get a NULL key and are skipped.
    """
    key = order_key()
    key = key if cond is None else F.when(cond, key)
    cost = _masked("cost", cond)
    return [
        F.min_by(F.col("cost"), key).alias("first_cost"),
        F.max_by(F.col("cost"), key).alias("last_cost"),
        F.max(cost).alias("max_cost"),
        F.min(cost).alias("min_cost"),
    ]


def order_stat_exprs(prefix: str, cond: Column | None = None, *,
                     cost: Column | None = None, qty: Column | None = None) -> list[Column]:
    """The seven statistics of a book/trade feed (sample stddev/variance)."""
    cost = cost if cost is not None else _masked("cost", cond)
    qty = qty if qty is not None else _masked("quantity", cond)
    return [
        F.avg(cost).alias(f"{prefix}_avg_cost"),
        F.stddev_samp(cost).alias(f"{prefix}_std_cost"),
        F.var_samp(cost).alias(f"{prefix}_var_cost"),
        F.sum(qty).alias(f"{prefix}_sum_quantity"),
        F.avg(qty).alias(f"{prefix}_avg_quantity"),
        F.stddev_samp(qty).alias(f"{prefix}_std_quantity"),
        F.var_samp(qty).alias(f"{prefix}_var_quantity"),
    ]


def distinct_levels(feed: DataFrame, keys: tuple[str, ...] = GROUP_KEYS) -> DataFrame:
    """Whole-row distinct of book levels inside each bucket.

    A level re-sent at every poll counts once.  In batch this plans as a
    partial + final hash aggregate on the level key (duplicates collapse
    map-side); on a watermarked stream it is ``dropDuplicates`` whose key
    includes the ``window`` struct, so its state is evicted with the window.
    """
    cols = [*keys, "feed", "cost", "quantity"]
    return feed.select(*cols).dropDuplicates(cols)


def price_ohlc(feed: DataFrame) -> DataFrame:
    """Open/close/high/low of the PRICE feed per bucket and symbol."""
    return (feed.where(F.col("feed") == C.PRICE)
            .groupBy(*GROUP_KEYS).agg(*ohlc_exprs()))


def order_stats(feed: DataFrame, feed_name: str, prefix: str,
                distinct: bool | None = None) -> DataFrame:
    """Seven statistics of one book or trade feed per bucket and symbol.

    Book feeds (BID/ASK) are made distinct first; trade feeds are not.
    """
    if distinct is None:
        distinct = feed_name in C.BOOK_FEEDS
    rows = feed.where(F.col("feed") == feed_name)
    if distinct:
        rows = distinct_levels(rows)
    return rows.groupBy(*GROUP_KEYS).agg(*order_stat_exprs(prefix))


def join_using(left: DataFrame, right: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Inner equi-join USING ``cols``: one copy of each key column."""
    return left.join(right, on=list(cols), how="inner")


def join_fold(frames: list[DataFrame], cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Left fold of inner USING-joins: a key missing from any input drops out;
    output columns follow input order."""
    return reduce(lambda a, b: join_using(a, b, cols), frames)


def finish(df: DataFrame, decimals: int | None = None, keep_window: bool = False) -> DataFrame:
    """Flatten a per-bucket summary for output.

    ``window`` becomes ``current_time`` (bucket start, TIMESTAMP_NTZ); double
    measures are rounded to ``decimals`` when given.
    """
    out = []
    for f in df.schema.fields:
        if f.name == "window":
            out.append(F.col("window.start").cast("timestamp_ntz").alias("current_time"))
            if keep_window:
                out.append(F.col("window.end").cast("timestamp_ntz").alias("window_end"))
        elif decimals is not None and f.dataType.typeName() == "double":
            out.append(F.round(F.col(f.name), decimals).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
