"""Registered queries: sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import narrow_to_float, to_double
from ..schemas import ORDER_SCHEMA, conform, quarantine_tag
from ..session import scratch_path
from ..sinks import orc as O
from ..sinks.kafka import encode_feed
from ..sources import files as FL
from ..sources import kafka as KF
from ..sources.fixtures import feed_table, kafka_records, raw_trades
from . import sqlgen as Q
from .registry import register, rounded
from .tv import saved_trade_volume


def _ntz(*cols):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


def _routed(spark, sf_dir):
    return KF.route(kafka_records(feed_table(spark, sf_dir)))


@register("topic_route", f"""WITH {Q.feed_sql()}
SELECT seq AS "offset", feed || '_' || currency AS topic, feed, currency
FROM feed WHERE feed IS NOT NULL AND currency IS NOT NULL""")
def q_topic_route(spark, sf_dir):
    """Records of all feed topics from one subscription, feed and symbol
    taken from the topic name."""
    r = _routed(spark, sf_dir)
    return r.select("offset", "topic", "feed", F.col("topic_currency").alias("currency"))


@register("decode_feed", f"""WITH {Q.feed_sql()}
SELECT seq AS "offset", feed, currency, cost,
       CASE WHEN feed = 'PRICE' THEN NULL ELSE quantity END AS quantity,
       CASE WHEN feed = 'PRICE' THEN make_timestamp(epoch_us(ts) // 1000 * 1000) END AS current_time,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS kafka_ts,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM feed WHERE feed IS NOT NULL AND currency IS NOT NULL""")
def q_decode_feed(spark, sf_dir):
    """JSON values of Kafka records decoded to typed rows (epoch millis ->
    timestamp; malformed records kept aside in ``_corrupt_record``)."""
    d = KF.decode(_routed(spark, sf_dir))
    return d.select("offset", "feed", "currency", "cost", "quantity",
                    *_ntz("current_time"), F.col("timestamp").cast("timestamp_ntz").alias("kafka_ts"),
                    KF.CORRUPT)


@register("encode_feed", f"""WITH {Q.feed_sql()}
SELECT seq, feed || '_' || currency AS topic,
       CASE WHEN feed = 'PRICE'
            THEN '{{"currency":"' || currency || '","cost":' || CAST(cost AS VARCHAR)
                 || ',"current_time":' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || '}}'
            ELSE '{{"currency":"' || currency || '","cost":' || CAST(cost AS VARCHAR)
                 || ',"quantity":' || CAST(quantity AS VARCHAR) || '}}' END AS value
FROM feed WHERE feed IS NOT NULL AND currency IS NOT NULL""")
def q_encode_feed(spark, sf_dir):
    """Feed rows as Kafka records: ``FEED_SYMBOL`` topic, JSON value."""
    e = encode_feed(feed_table(spark, sf_dir))
    return e.where(F.col("topic").rlike("^" + KF.TOPIC_PATTERN + "$")).select("seq", "topic", "value")


@register("conform_schema", f"""WITH {Q.feed_sql()}
SELECT currency, cost, quantity FROM feed WHERE feed IN ('SELL', 'BUY')""")
def q_conform_schema(spark, sf_dir):
    """Raw trades with bean-style column names and text numbers conformed
    to the declared order schema (case-insensitive match, safe casts)."""
    raw = raw_trades(feed_table(spark, sf_dir))
    bean = raw.select(F.col("currency").alias("Currency"), F.col("price").alias("Cost"),
                      F.col("qty").alias("Quantity"))
    return conform(bean, ORDER_SCHEMA)


@register("quarantine_split", f"""WITH {Q.feed_sql()}
SELECT seq AS "offset", currency, cost,
       CASE WHEN feed = 'PRICE' THEN NULL ELSE quantity END AS quantity,
       CASE WHEN feed = 'PRICE' THEN 'missing:quantity' END AS reason
FROM feed WHERE feed IS NOT NULL AND currency IS NOT NULL""")
def q_quarantine_split(spark, sf_dir):
    """All decoded messages checked against the order schema: messages
    without a quantity (price ticks) are tagged for quarantine."""
    d = KF.decode(_routed(spark, sf_dir)).select("offset", "currency", "cost", "quantity")
    return quarantine_tag(d, ORDER_SCHEMA, keep=["offset"])


@register("numeric_narrowing", f"""WITH {Q.feed_sql()}
SELECT seq, CAST(CAST(cost AS VARCHAR) AS DOUBLE) AS cost,
       CAST(CAST(CAST(quantity AS VARCHAR) AS FLOAT) AS DOUBLE) AS quantity
FROM feed WHERE feed IN ('SELL', 'BUY')""")
def q_numeric_narrowing(spark, sf_dir):
    """Text price -> double; text quantity -> float -> double."""
    raw = raw_trades(feed_table(spark, sf_dir))
    return raw.select("seq", to_double("price").alias("cost"), narrow_to_float("qty").alias("quantity"))


@register("csv_symbols", f"""WITH {Q.feed_sql()}
SELECT currency AS currencies, count(*) AS n FROM feed GROUP BY currency""")
def q_csv_symbols(spark, sf_dir):
    """Symbol column written as CSV with a ``currencies`` header and read
    back with a declared schema; symbols with their row counts."""
    path = scratch_path(spark, "csv_symbols")
    feed_table(spark, sf_dir).select(F.col("currency").alias("currencies")) \
        .write.option("header", True).csv(path)
    return FL.read_csv(spark, path).groupBy("currencies").agg(F.count(F.lit(1)).alias("n"))


@register("series_union", f"""WITH {Q.feed_sql()}
SELECT currency, ts, cost FROM feed WHERE feed = 'PRICE' AND currency IS NOT NULL""")
def q_series_union(spark, sf_dir):
    """Per-symbol PRICE series stored one directory per symbol, read back as
    one DataFrame with the symbol taken from the path."""
    base = scratch_path(spark, "series")
    price = feed_table(spark, sf_dir).where(F.col("feed") == C.PRICE) \
        .where(F.col("currency").isNotNull()).select("currency", *_ntz("ts"), "cost")
    FL.write_symbol_series(price, base)
    return FL.read_symbol_series(spark, base).select("currency", "ts", "cost")


def _write_fragmented(spark, sf_dir, table=None, path=None, appends=3):
    tv = saved_trade_volume(spark, sf_dir)
    tasks = spark.sparkContext.defaultParallelism      # table-sized appends
    for part in O.hash_slices(tv, appends):
        O.append_partitioned(part, table=table, path=path, tasks=tasks)


@register("orc_partitioned_roundtrip", Q.trade_volume())
def q_orc_partitioned_roundtrip(spark, sf_dir):
    """Fact rows appended in three batches to ORC partitioned by
    (current_day, currency) and read back."""
    path = scratch_path(spark, "trade_volume_orc")
    _write_fragmented(spark, sf_dir, path=path)
    return rounded(O.read_partitioned(spark, path))


@register("tv_one_symbol", f"WITH {Q.trade_volume_cte()} SELECT * FROM tv WHERE currency = 'BTCUSDT'")
def q_tv_one_symbol(spark, sf_dir):
    """One symbol's rows from the partitioned ORC table (partition filter:
    only that symbol's directories are listed and read)."""
    path = scratch_path(spark, "trade_volume_orc")
    _write_fragmented(spark, sf_dir, path=path)
    from ..operators.analysis import one_symbol
    return rounded(one_symbol(O.read_partitioned(spark, path), "BTCUSDT"))


@register("compact_partitions", Q.trade_volume())
def q_compact_partitions(spark, sf_dir):
    """Fact table appended in small writes, then compacted in place by a
    dynamic partition overwrite of itself; all rows kept."""
    loc = scratch_path(spark, "warehouse")
    db = C.DATABASE
    O.create_database(spark, db, f"{loc}/{db}.db")
    table = f"{db}.{C.TRADE_VOLUME_TABLE}_{loc.rsplit('-', 1)[-1]}"
    _write_fragmented(spark, sf_dir, table=table, path=f"{loc}/{db}.db/{C.TRADE_VOLUME_TABLE}")
    return rounded(O.compact(spark, table))
