"""Ordered per-key series without one task per key.

A symbol may hold a third of all rows, so nothing here partitions by the key
alone.

* :func:`with_series_index` numbers each key's rows 0..n-1 in ``order``:
  rows are range-partitioned by (key, order, a hash of the row), so partition
  bounds follow the row *counts* and ties are split too, and are written once in
  the shared folder with their place.  A table of one row per (key,
  partition) gives each partition's offset in its key by a running sum, and
  carries any per-key totals along; no join on the bare key is left.
* :func:`with_lags` adds ``lag(col, k)`` by the index: rows are grouped by
  index chunk, and the last ``max(k)`` rows of each chunk are copied into the
  next one as a halo, so each window partition holds at most
  ``chunk_rows + max(k)`` rows.
* :func:`in_chunks` hands the same chunks, with a halo of any length, and the row that a key has in a
  second table to an Arrow function.

NULL keys form a key of their own and NULL order values sort last; no row is
dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

DEFAULT_CHUNK_ROWS = 1_000_000
PARTS_BROADCAST = 1_000_000      # (key, partition) rows broadcast at most

Total = tuple[Column, Callable[[str], Column]]


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def with_series_index(df: DataFrame, key: str | list[str], order: str | list[str], index: str = "t",
                      totals: dict[str, Total] | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``index`` = 0-based position of each row within its ``key`` (one or
    several columns) when sorted by ``order``; equal rows in any order.

    ``totals`` adds per-key values: name -> (aggregate over rows, function that
    combines the named partial aggregates), e.g. ``{"_n": (F.count("y"), F.sum)}``.
    """
    keys = _keys(key)
    orders = [order] if isinstance(order, str) else list(order)
    by = [F.col(c).asc_nulls_last() for c in [*keys, *orders]] + [F.xxhash64(*df.columns).asc()]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    # the id grows by one per row of a partition; its upper bits are the partition
    placed = materialise(ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "series")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    totals = totals or {}
    parts = placed.groupBy(*keys, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"),
        *[agg.alias(name) for name, (agg, _) in totals.items()])
    in_key = Window.partitionBy(*keys)
    before = in_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"),
        *[combine(name).over(in_key).alias(name) for name, (_, combine) in totals.items()])
    parts = materialise(parts, "series-parts")
    if parts.count() <= PARTS_BROADCAST:
        parts = F.broadcast(parts)
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (placed.join(parts, on)
            .withColumn(index, (F.col("_off") + F.col("_at") - F.col("_first")).cast("long"))
            .drop("_at", "_part", "_p", "_first", "_off", *[f"_k{i}" for i in range(len(keys))]))


def with_lags(df: DataFrame, key: str | list[str], index: str, cols: list[str], lags: list[int],
              chunk_rows: int = DEFAULT_CHUNK_ROWS, name: str = "{col}_lag{k}") -> DataFrame:
    """Add ``lag(col, k)`` for every col and k, by position ``index``
    (consecutive 0..n-1 per key, as :func:`with_series_index` gives)."""
    lmax = max(lags) if lags else 0
    if lmax == 0:
        return df
    size = max(chunk_rows, lmax)
    part = F.floor(F.col(index) / size)
    halo = (F.col(index) % size) >= (size - lmax)
    copies = df.withColumn("_own", part).withColumn(
        "_part", F.explode(F.when(halo, F.array(part, part + 1)).otherwise(F.array(part))))
    w = Window.partitionBy(*_keys(key), "_part").orderBy(index)
    out = copies.select("*", *[F.lag(c, k).over(w).alias(name.format(col=c, k=k))
                               for c in cols for k in lags])
    return out.where(F.col("_part") == F.col("_own")).drop("_own", "_part")


def in_chunks(df: DataFrame, per_key: DataFrame, key: str, index: str, rows: str, halo: Column, fn, schema: str,
              chunk_rows: int = 200_000) -> DataFrame:
    """``fn(chunk, own)`` over index chunks of every key: ``chunk`` is an Arrow table of a chunk's rows, preceded by the last
    ``halo`` rows before it, with ``_part_start`` (index of its first own row); ``own`` is the key's row of ``per_key``.
    Both frames have ``rows`` (rows of the key) and the columns that ``halo`` is made of."""
    size = F.greatest(F.lit(chunk_rows), halo).cast("long")
    part = F.floor(F.col(index) / size)
    near_end = (F.col(index) % size >= size - halo) & ((part + 1) * size < F.col(rows))
    left = (df.withColumn("_part", F.explode(F.when(near_end, F.array(part, part + 1)).otherwise(F.array(part))))
            .withColumn("_part_start", F.col("_part") * size))
    right = per_key.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(rows) - 1) / size))))
    return left.groupBy(key, "_part").cogroup(right.groupBy(key, "_part")).applyInArrow(fn, schema)
