"""File readers: CSV with a header, per-symbol series directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SYMBOL_LIST_SCHEMA = T.StructType([T.StructField("currencies", T.StringType(), True)])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = SYMBOL_LIST_SCHEMA) -> DataFrame:
    """CSV with a header row, declared schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_symbol_series(df: DataFrame, base: str, key: str = "currency",
                        fmt: str = "parquet") -> None:
    """One directory per symbol (``base/symbol=XYZ``), as a per-symbol
    download lands them."""
    df.withColumnRenamed(key, "symbol").write.mode("overwrite").partitionBy("symbol") \
        .format(fmt).save(base)


def read_symbol_series(spark: SparkSession, base: str, symbols: list[str] | None = None,
                       key: str = "currency", fmt: str = "parquet") -> DataFrame:
    """All per-symbol series as ONE DataFrame, the symbol taken from the path.

    A single multi-path read replaces a loop of per-symbol frames folded
    with unions: one scan, one plan, partition pruning on the symbol.
    """
    reader = spark.read.format(fmt).option("basePath", base)
    df = reader.load(*[f"{base}/symbol={s}" for s in symbols]) if symbols else reader.load(base)
    return df.withColumnRenamed("symbol", key)
