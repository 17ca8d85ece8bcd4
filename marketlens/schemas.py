"""Declared schemas (no inference from a first row) and the conform step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import config as C

# Record shapes of the three feed families.
PRICE_SCHEMA = T.StructType([
    T.StructField("currency", T.StringType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("current_time", T.TimestampType(), True),
])
ORDER_SCHEMA = T.StructType([          # book level (bid/ask) and executed trade (sell/buy)
    T.StructField("currency", T.StringType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("quantity", T.DoubleType(), True),
])

# JSON on the wire: time travels as epoch milliseconds, so it is declared as a
# long and converted with timestamp_millis (from_json would read it as seconds).
WIRE_SCHEMA = T.StructType([
    T.StructField("currency", T.StringType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("quantity", T.DoubleType(), True),
    T.StructField("current_time", T.LongType(), True),
])

# Column layout of a Kafka record as Spark's Kafka source delivers it.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Long feed table every operator starts from.
FEED_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("us", T.LongType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("feed", T.StringType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("quantity", T.DoubleType(), True),
])

STAT_SUFFIXES: tuple[str, ...] = (
    "avg_cost", "std_cost", "var_cost",
    "sum_quantity", "avg_quantity", "std_quantity", "var_quantity",
)
PRICE_COLUMNS: tuple[str, ...] = ("first_cost", "last_cost", "max_cost", "min_cost")


def stat_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in STAT_SUFFIXES]


MEASURE_COLUMNS: list[str] = list(PRICE_COLUMNS) + [
    c for _, p in C.STAT_PREFIX for c in stat_columns(p)
]

# Wide fact table: 1 + 4 + 28 + 2 = 35 columns.
TRADE_VOLUME_SCHEMA = T.StructType(
    [T.StructField("currency", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASURE_COLUMNS]
    + [T.StructField("current_time", T.TimestampType(), True),
       T.StructField("current_day", T.DateType(), True)]
)


def conform(df: DataFrame, schema: T.StructType, *, strict_names: bool = False) -> DataFrame:
    """Project a DataFrame onto a declared schema.

    Columns are matched case-insensitively, cast with ``try_cast`` (a value
    that does not convert becomes NULL instead of failing the job under ANSI
    mode) and renamed to the declared spelling.  Missing columns become typed
    NULLs.  This is the whole-DataFrame form of a bean-to-row conversion.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols: list[Column] = []
    for f in schema.fields:
        src = f.name if strict_names else by_lower.get(f.name.lower())
        if src is None or src not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def quarantine_tag(df: DataFrame, schema: T.StructType, required: list[str] | None = None,
                   keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Conform ``df`` to ``schema`` and add ``reason``: NULL for a good row,
    ``missing:<field>`` when a required source value is absent, or
    ``bad_type:<field>`` when it is present but does not convert.  ``keep``
    columns pass through unchanged."""
    required = required or [f.name for f in schema.fields]
    by_lower = {c.lower(): c for c in df.columns}
    types = {f.name: f.dataType for f in schema.fields}

    def converted(name: str) -> Column:
        src = by_lower.get(name.lower())
        return F.col(src).try_cast(types[name]) if src else F.lit(None).cast(types[name])

    checks = []
    for c in required:
        src = by_lower.get(c.lower())
        if src is None:
            checks.append(F.lit(f"missing:{c}"))
        else:
            checks.append(F.when(F.col(src).isNull(), F.lit(f"missing:{c}"))
                          .when(converted(c).isNull(), F.lit(f"bad_type:{c}")))
    return df.select(*keep, *[converted(f.name).alias(f.name) for f in schema.fields],
                     F.coalesce(*checks).alias("reason"))


def quarantine_split(df: DataFrame, schema: T.StructType,
                     required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good rows conformed to ``schema``; bad rows keep their
    original columns plus ``reason``.  Nothing becomes a silent NULL row."""
    src = [F.col(f"`{c}`").alias(f"_src_{i}") for i, c in enumerate(df.columns)]
    t = quarantine_tag(df, schema, required, keep=src)
    good = t.where(F.col("reason").isNull()).select(*[f.name for f in schema.fields])
    bad = t.where(F.col("reason").isNotNull()).select(
        *[F.col(f"_src_{i}").alias(c) for i, c in enumerate(df.columns)], "reason")
    return good, bad
