"""Feed rows -> Kafka records (one topic per feed and symbol, JSON value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import topic_of


def encode_feed(feed: DataFrame) -> DataFrame:
    """Long feed rows -> ``(key, value, topic)`` with a NULL key.

    PRICE messages carry ``currency, cost, current_time`` (epoch millis);
    book and trade messages carry ``currency, cost, quantity``.
    """
    is_price = F.col("feed") == C.PRICE
    price = F.to_json(F.struct("currency", "cost", F.unix_millis("ts").alias("current_time")))
    order = F.to_json(F.struct("currency", "cost", "quantity"))
    return feed.select(
        F.lit(None).cast("binary").alias("key"),
        F.when(is_price, price).otherwise(order).alias("value"),
        topic_of("feed", "currency").alias("topic"),
        *[c for c in ("seq", "ts") if c in feed.columns],
    )


def write_kafka(records: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Publish ``(key, value, topic)`` rows with Spark's Kafka sink (needs the
    spark-sql-kafka package on the cluster)."""
    w = records.select("key", F.col("value").cast("binary").alias("value"), "topic") \
        .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()
