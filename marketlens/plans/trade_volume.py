"""The wide ``trade_volume`` fact row: one row per (bucket, symbol) holding the
price summary and the four order-statistics blocks.

Two equivalent plans are provided:

* :func:`trade_volume_fold` — five per-feed aggregates joined on
  ``(window, currency)`` by an inner-join fold (the reference semantics: a
  symbol missing from any feed disappears).
* :func:`trade_volume_onepass` — one scan of the long feed table and no
  join: a first aggregate reduces book rows to distinct levels and every
  other feed to one partial summary per (window, currency, feed) (map-side
  partials, one exchange), a second one builds the wide row from that
  reduced data, and a presence predicate keeps the groups present in every
  feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import stats as S
from ..schemas import MEASURE_COLUMNS


def _finish(df: DataFrame, decimals: int | None) -> DataFrame:
    """Stamp bucket time/day and order the 35 columns of the wide table.

    ``decimals`` rounds every measure (used when comparing against another
    engine: sample variances land on exact decimal ties otherwise).
    """
    def measure(c: str) -> Column:
        return F.round(F.col(c), decimals).alias(c) if decimals is not None else F.col(c)
    return df.select(
        "currency",
        *[measure(c) for c in MEASURE_COLUMNS if c in df.columns],
        F.col("window.start").cast("timestamp_ntz").alias("current_time"),
        F.to_date(F.col("window.start")).alias("current_day"),
    )


def trade_volume_onepass(feed: DataFrame, step: str = "1 day", *,
                         require_all: bool = True, decimals: int | None = None,
                         bucketed: bool = False, watermark: str | None = None) -> DataFrame:
    """The wide row from ONE pass over the long feed table, without joins.

    One scan and two aggregates (:func:`_one_scan`), in batch and on streams.

    ``watermark`` (streams): one watermark on the merged feed stream; the
    first aggregate's state holds the distinct book levels and per-feed
    partials of open windows and is evicted when a window closes, the second
    emits the wide row in the same batch.

    ``feed``: long feed table ``(seq, ts, us, currency, feed, cost, quantity)``
    (streaming or batch).  ``require_all`` keeps only (bucket, symbol) groups
    present in every feed, exactly like the inner-join fold.
    """
    if feed.isStreaming and watermark is None:
        raise ValueError("a streaming feed needs a watermark delay")
    if watermark is not None:
        feed = feed.withWatermark("ts", watermark)
    out = _one_scan(feed if bucketed else S.with_bucket(feed, step))
    if require_all:
        out = out.where(F.least(*[F.col(f"_n_{n}") for n in C.FEEDS]) > 0)
    return _finish(out, decimals)


def _one_scan(f: DataFrame) -> DataFrame:
    """ONE scan, two aggregates (batch, streams and per-batch summaries).

    1. Raw rows are grouped by ``(window, currency, feed, level_cost,
       level_qty)``, the level columns being set for book rows only: book
       rows collapse to their distinct levels (the dedup) and every other
       feed to one partial summary per (window, currency, feed) — ten
       unmasked functions per row, all with map-side partial aggregation,
       so a hot symbol or level is collapsed before the exchange.
    2. The reduced rows (distinct levels + one row per other feed) are
       aggregated per (window, currency) with feed-masked functions.

    Sample stddev of the pre-aggregated feeds is ``sqrt(var_samp)``, exactly
    how Spark's ``stddev_samp`` evaluates.
    """
    fe = F.col("feed")
    is_book = fe.isin(*C.BOOK_FEEDS)
    key = F.when(fe == C.PRICE, S.order_key())
    stage1 = f.groupBy(*S.GROUP_KEYS, "feed",
                       F.when(is_book, F.col("cost")).alias("level_cost"),
                       F.when(is_book, F.col("quantity")).alias("level_qty")).agg(
        F.min_by("cost", key).alias("first_cost"), F.max_by("cost", key).alias("last_cost"),
        F.max("cost").alias("max_cost"), F.min("cost").alias("min_cost"),
        F.avg("cost").alias("avg_cost"), F.var_samp("cost").alias("var_cost"),
        F.sum("quantity").alias("sum_quantity"), F.avg("quantity").alias("avg_quantity"),
        F.var_samp("quantity").alias("var_quantity"))

    def one(name: str, col: str) -> Column:        # the single row of a non-book feed
        return F.max(F.when(fe == name, F.col(col)))

    def lv(name: str, col: str) -> Column:         # the distinct levels of a book feed
        return F.when(fe == name, F.col(col))
    aggs = [one(C.PRICE, c).alias(c) for c in ("first_cost", "last_cost", "max_cost", "min_cost")]
    for name, prefix in C.STAT_PREFIX:
        if name in C.BOOK_FEEDS:
            aggs += S.order_stat_exprs(prefix, None, cost=lv(name, "level_cost"),
                                       qty=lv(name, "level_qty"))
        else:
            aggs += [one(name, "avg_cost").alias(f"{prefix}_avg_cost"),
                     F.sqrt(one(name, "var_cost")).alias(f"{prefix}_std_cost"),
                     one(name, "var_cost").alias(f"{prefix}_var_cost"),
                     one(name, "sum_quantity").alias(f"{prefix}_sum_quantity"),
                     one(name, "avg_quantity").alias(f"{prefix}_avg_quantity"),
                     F.sqrt(one(name, "var_quantity")).alias(f"{prefix}_std_quantity"),
                     one(name, "var_quantity").alias(f"{prefix}_var_quantity")]
    aggs += [F.count_if(fe == name).alias(f"_n_{name}") for name in C.FEEDS]
    return stage1.groupBy(*S.GROUP_KEYS).agg(*aggs)


def trade_volume_fold(feed: DataFrame, step: str = "1 day", *,
                      decimals: int | None = None, bucketed: bool = False) -> DataFrame:
    """Five per-feed aggregates folded by inner joins on (window, currency)."""
    f = feed if bucketed else S.with_bucket(feed, step)
    frames = [S.price_ohlc(f)] + [S.order_stats(f, name, prefix) for name, prefix in C.STAT_PREFIX]
    return _finish(S.join_fold(frames, S.GROUP_KEYS), decimals)


def trade_volume_batch(feed: DataFrame, now, *, decimals: int | None = None) -> DataFrame:
    """Reference micro-batch semantics: the whole input is one batch.

    The per-symbol summaries of the five feeds (book levels distinct within
    the batch), kept for symbols present in every feed — the same single-scan
    plan as :func:`trade_volume_onepass` with one bucket for the batch —
    stamped with ``now`` (the batch's processing instant, a Column or
    literal) and its day.
    """
    from ..operators.analysis import stamp_columns
    one_bucket = feed.withColumn("window", F.lit(None).cast("struct<start:timestamp,end:timestamp>"))
    out = _one_scan(one_bucket)
    out = out.where(F.least(*[F.col(f"_n_{n}") for n in C.FEEDS]) > 0)
    now_col = now if isinstance(now, Column) else F.lit(now)
    out = stamp_columns(out.select("currency", *MEASURE_COLUMNS), now_col.cast("timestamp_ntz"))
    if decimals is not None:
        out = out.select(*[F.round(c, decimals).alias(c) if c in MEASURE_COLUMNS else F.col(c)
                           for c in out.columns])
    return out
