"""Stand-in inputs built from the driver's test tables.

The engine's real inputs are exchange feeds (Kafka topics, files or tables).
For testing and benchmarking, these helpers map the driver's ``events`` table
onto the long feed schema ``(seq, ts, us, currency, feed, cost, quantity)``
and derive the other record shapes (wire messages, order-book snapshots, raw
trades) from it.  They only give rows the jobs expect; no job takes a result
or a shortcut from how these rows are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .tables import read_table

# --- fixed values: event type -> feed, in feed order ---------------------------
EVENT_FEED: dict[str, str] = {
    "view": C.PRICE,
    "click": C.BID,
    "error": C.ASK,
    "signup": C.SELL,
    "purchase": C.BUY,
}


def _feed_of(event_type: Column) -> Column:
    expr = None
    for ev, feed in EVENT_FEED.items():
        expr = (F.when(event_type == ev, F.lit(feed)) if expr is None
                else expr.when(event_type == ev, F.lit(feed)))
    return expr


def feed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a long feed table.

    seq = event_id; ts = event time as TIMESTAMP (session zone UTC) and
    ``us`` = its epoch microseconds, both computed before any watermark;
    currency = symbol number ``user_id % 11``; book levels get a coarse cost
    and a small integer quantity (so repeated levels exist); other feeds keep
    the value and a float-narrowed quantity.
    """
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    symbols = F.array(*[F.lit(s) for s in C.SYMBOLS])
    feed = _feed_of(F.col("event_type"))
    is_book = feed.isin(*C.BOOK_FEEDS)
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id").alias("seq"),
        ts.alias("ts"),
        F.unix_micros(ts).alias("us"),
        F.try_element_at(symbols, (F.col("user_id") % len(C.SYMBOLS) + 1).cast("int")).alias("currency"),
        feed.alias("feed"),
        F.when(is_book, F.round(F.col("value") / 10, 0)).otherwise(F.col("value")).alias("cost"),
        F.when(is_book, (k % 4).cast("double"))
         .otherwise(((k + 1) / 10).cast("float").cast("double")).alias("quantity"),
    )


def feed_sql(alias: str = "feed") -> str:
    """The same mapping for DuckDB (used by the oracle SQL)."""
    syms = ", ".join(f"'{s}'" for s in C.SYMBOLS)
    cases = " ".join(f"WHEN '{e}' THEN '{f}'" for e, f in EVENT_FEED.items())
    book = ", ".join(f"'{b}'" for b in C.BOOK_FEEDS)
    return f"""{alias}_raw AS (
  SELECT event_id AS seq, ts, epoch_us(ts) AS us,
         [{syms}][user_id % {len(C.SYMBOLS)} + 1] AS currency,
         CASE event_type {cases} END AS feed,
         value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
{alias} AS (
  SELECT seq, ts, us, currency, feed,
         CASE WHEN feed IN ({book}) THEN round(value / 10, 0) ELSE value END AS cost,
         CASE WHEN feed IN ({book}) THEN CAST(k % 4 AS DOUBLE)
              ELSE CAST(CAST((k + 1) / 10 AS FLOAT) AS DOUBLE) END AS quantity
  FROM {alias}_raw)"""


def kafka_records(feed: DataFrame) -> DataFrame:
    """Feed rows as Kafka records (the source's column layout): JSON value
    from :func:`marketlens.sinks.kafka.encode_feed`, offset = seq, record
    time = event time at millisecond precision."""
    from ..sinks.kafka import encode_feed
    enc = encode_feed(feed)
    return enc.select(
        "key", F.col("value").cast("binary").alias("value"), "topic",
        F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        F.timestamp_millis(F.unix_millis("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"))


def raw_trades(feed: DataFrame) -> DataFrame:
    """Executed trades as an exchange returns them: text price/quantity, a
    buyer-is-maker flag (here: even seq) and the trade time."""
    return feed.where(F.col("feed").isin(*C.TRADE_FEEDS)).select(
        "seq", "currency",
        F.col("cost").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("qty"),
        (F.col("seq") % 2 == 0).alias("is_buyer_maker"),
        F.col("ts").alias("ts"))


def order_books(feed: DataFrame, snapshot: str = f"{C.BOOK_POLL_SECONDS} seconds") -> DataFrame:
    """Order-book snapshots as an exchange returns them: per (snapshot
    window, currency) a ``bids`` array sorted best (highest) first and an
    ``asks`` array sorted best (lowest) first, levels as text
    ``struct(price, qty)``.  One snapshot per book poll interval, i.e. one
    response per poll."""
    book = feed.where(F.col("feed").isin(*C.BOOK_FEEDS)).withColumn(
        "snapshot", F.window("ts", snapshot).start)
    lvl = F.struct("cost", "quantity")

    def as_text(arr):
        return F.transform(arr, lambda x: F.struct(x["cost"].cast("string").alias("price"),
                                                   x["quantity"].cast("string").alias("qty")))
    books = book.groupBy("snapshot", "currency").agg(
        F.array_sort(F.collect_list(F.when(F.col("feed") == C.BID, lvl))).alias("_b"),
        F.array_sort(F.collect_list(F.when(F.col("feed") == C.ASK, lvl))).alias("_a"))
    return books.select("snapshot", "currency", as_text(F.reverse("_b")).alias("bids"),
                        as_text(F.col("_a")).alias("asks"))
