"""Feed-level operators: symbol filter, trade routing, time-range filter
with a per-poll limit, order-book flattening and depth limit, latest value
per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import narrow_to_float, to_double
from .stats import order_key

def parse_symbols(spec: str) -> list[str]:
    """Comma-separated symbol list from configuration."""
    return [s.strip() for s in spec.split(",") if s.strip()]


def filter_symbols(df: DataFrame, symbols: list[str] | DataFrame, key: str = "currency") -> DataFrame:
    """Rows whose ``key`` is one of ``symbols``: a list (configuration) is an
    ``IN`` predicate, pushed into the scan; a DataFrame is a ``left_semi`` join."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(symbols.columns[0]).alias(key)).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(*symbols))


def route_trades(raw: DataFrame) -> DataFrame:
    """Raw exchange trades -> SELL/BUY feed rows.

    Buyer-is-maker -> SELL, otherwise BUY; a NULL flag gets no feed (the
    caller quarantines it) instead of silently becoming BUY.  Price text ->
    double; quantity text -> float -> double, the precision the producer
    keeps.
    """
    flag = F.col("is_buyer_maker")
    return raw.select(
        "*",
        F.when(flag, F.lit(C.SELL)).when(~flag, F.lit(C.BUY)).alias("feed"),
        to_double("price").alias("cost"),
        narrow_to_float("qty").alias("quantity"),
    ).drop("price", "qty")


def poll_limited(trades: DataFrame, poll: str = f"{C.TRADE_POLL_SECONDS} seconds",
                 limit: int = C.TRADE_LIMIT, ts: str = "ts") -> DataFrame:
    """At most ``limit`` trades per symbol and poll window, oldest first (an
    exchange answers a time-range query with at most ``limit`` rows).

    The window partition is (symbol, poll window): bounded by time, never a
    whole symbol.
    """
    w = Window.partitionBy("currency", "_poll").orderBy(ts, "seq")
    return (trades.withColumn("_poll", F.window(ts, poll).start)
            .withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") <= limit)
            .withColumnRenamed("_poll", "poll_start").drop("_rank"))


def in_time_range(df: DataFrame, end: Column, length: str, ts: str = "ts") -> DataFrame:
    """Rows with ``end - length <= ts <= end`` (a pushed-down range filter)."""
    return df.where(F.col(ts).between(end - F.expr(f"INTERVAL {length}"), end))


def book_explode(books: DataFrame) -> DataFrame:
    """Order-book snapshots -> one row per level with its side and depth
    index (0 = first level as received).  One ``inline`` over the
    concatenation of both sides; duplicates are kept (no set union)."""
    def side(arr: str, name: str) -> Column:
        return F.transform(F.col(arr), lambda x, i: F.struct(
            F.lit(name).alias("side"), i.cast("long").alias("level"),
            to_double(x["price"]).alias("price"), narrow_to_float(x["qty"]).alias("qty")))
    keys = [c for c in books.columns if c not in ("bids", "asks")]
    return books.select(*keys, F.inline(F.concat(side("bids", C.BID), side("asks", C.ASK))))


def book_top_n(levels: DataFrame, n: int = C.BOOK_DEPTH,
               snapshot_keys: tuple[str, ...] = ("snapshot", "currency")) -> DataFrame:
    """Best ``n`` levels per snapshot, symbol and side: highest bids, lowest
    asks (ties by quantity, larger first).  Partition size is bounded by one
    snapshot's book."""
    price_rank = F.when(F.col("side") == C.BID, -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*snapshot_keys, "side").orderBy(price_rank, F.col("qty").desc(), "level")
    return levels.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def latest_by_key(feed: DataFrame, keys: tuple[str, ...] = ("currency", "feed"),
                  values: tuple[str, ...] = ("cost", "quantity", "ts", "seq")) -> DataFrame:
    """Latest row per key by arrival order ``(us, seq)``.

    One ``max_by`` per value column on the decimal order key: mutable
    aggregation buffers, so a hash aggregate with map-side partials; works as
    an update-mode streaming aggregate too.
    """
    key = order_key()
    return feed.groupBy(*keys).agg(*[F.max_by(F.col(v), key).alias(v) for v in values])
