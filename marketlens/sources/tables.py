"""Parquet tables the engine reads (column-pruned, filters pushed down)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor directory.

    No ``select *`` is materialised here: callers project what they use and
    Catalyst prunes the scan's ``ReadSchema`` accordingly.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
