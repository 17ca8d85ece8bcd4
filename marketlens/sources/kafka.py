"""Kafka source: subscribe to the five topic families, route by topic name,
decode the JSON value into the long feed schema.

The reader is a thin wrapper over Spark's Kafka source (batch and stream);
``route`` and ``decode`` are plain column expressions, so they run unchanged
on a static frame with the Kafka column layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.scalars import epoch_millis_to_ts, topic_currency, topic_feed
from ..schemas import WIRE_SCHEMA

TOPIC_PATTERN = "(" + "|".join(C.FEEDS) + ")_.*"
CORRUPT = "_corrupt_record"


def topics(symbols=C.SYMBOLS, feeds=C.FEEDS) -> list[str]:
    return [f"{f}_{s}" for f in feeds for s in symbols]


def read_kafka(spark: SparkSession, bootstrap_servers: str, *, stream: bool = True,
               pattern: str = TOPIC_PATTERN, starting_offsets: str = "latest",
               **options: str) -> DataFrame:
    """One subscription for all feeds.  Offsets live in the query checkpoint,
    so a restart resumes exactly; ``startingOffsets`` only applies the first
    time."""
    r = (spark.readStream if stream else spark.read).format("kafka") \
        .option("kafka.bootstrap.servers", bootstrap_servers) \
        .option("subscribePattern", pattern) \
        .option("startingOffsets", starting_offsets)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def route(records: DataFrame) -> DataFrame:
    """Add ``feed``/``currency`` taken from the topic name; keep only topics
    of a known feed family."""
    out = records.withColumn("feed", topic_feed("topic")).withColumn(
        "topic_currency", topic_currency("topic"))
    return out.where(F.col("topic").rlike("^" + TOPIC_PATTERN + "$"))


def decode(records: DataFrame, failfast: bool = False) -> DataFrame:
    """Parse the JSON value of routed records.

    Good fields are kept even when others fail; a record that is not valid
    JSON (or has a wrongly typed field) keeps its text in ``_corrupt_record``
    (PERMISSIVE), unless ``failfast``.  Epoch-millis ``current_time`` becomes
    a TIMESTAMP (declared as a long on the wire: parsed as a timestamp it
    would be read as seconds).
    """
    schema = T.StructType(WIRE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    opts = {"mode": "FAILFAST"} if failfast else {"mode": "PERMISSIVE",
                                                   "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.withColumn("_m", F.from_json(F.col("value").cast("string"), schema, opts))
    return parsed.select(
        *[c for c in records.columns if c not in ("key", "value")],
        F.col("_m.currency").alias("currency"),
        F.col("_m.cost").alias("cost"),
        F.col("_m.quantity").alias("quantity"),
        epoch_millis_to_ts(F.col("_m.current_time")).alias("current_time"),
        F.col(f"_m.{CORRUPT}").alias(CORRUPT),
    )


def as_feed(decoded: DataFrame) -> DataFrame:
    """Decoded records -> long feed table.  Event time is the payload time
    when present (PRICE), else the record timestamp; ``seq`` is the offset,
    which orders records within a topic partition (one topic per feed and
    symbol, so first/last of a summary break equal-instant ties by arrival
    within that topic; across partitions of one topic such ties are broken
    by offset alone)."""
    ts = F.coalesce(F.col("current_time"), F.col("timestamp"))
    return decoded.where(F.col(CORRUPT).isNull()).select(
        F.col("offset").alias("seq"), ts.alias("ts"), F.unix_micros(ts).alias("us"),
        F.coalesce("currency", "topic_currency").alias("currency"), "feed", "cost", "quantity")


def undecodable(decoded: DataFrame) -> DataFrame:
    """The records :func:`as_feed` leaves out, with the text that did not parse:
    the rows of a quarantine table, so that no message disappears."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(
        "topic", "partition", "offset", "timestamp", F.col(CORRUPT).alias("value"),
        F.lit("not a feed message").alias("reason"))
