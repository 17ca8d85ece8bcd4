"""Batch analysis over the wide fact table: column hygiene, per-symbol
ordering, chart projections and the correlation matrix.

Everything stays in Spark; only small results are ever collected.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MEASURE_COLUMNS


def qualify(df: DataFrame, table: str) -> DataFrame:
    """Name every column ``table.col`` — the shape of a ``SELECT *`` result
    fetched through a HiveServer2/JDBC connection."""
    return df.toDF(*[f"{table}.{c}" for c in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove ``prefix`` from every column name that starts with it (names
    without the prefix are left alone, unlike a blind fixed-length cut)."""
    return df.toDF(*[c[len(prefix):] if c.startswith(prefix) else c for c in df.columns])


def one_symbol(df: DataFrame, symbol: str, key: str = "currency") -> DataFrame:
    """Rows of one symbol; on a table partitioned by ``key`` this is a
    partition filter, so only that symbol's files are read."""
    return df.where(F.col(key) == F.lit(symbol))


def symbols(df: DataFrame, key: str = "currency") -> DataFrame:
    """Distinct key values."""
    return df.select(key).distinct()


def min_time(df: DataFrame, col: str = "current_time", out: str = "min_time") -> DataFrame:
    """Global minimum of a timestamp column (one row)."""
    return df.agg(F.min(col).alias(out))


def stamp_columns(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Add ``current_time`` (processing time, or the given instant) and
    ``current_day`` derived from it, so both always agree."""
    t = now if now is not None else F.current_timestamp()
    return df.withColumn("current_time", t).withColumn("current_day", F.to_date(F.col("current_time")))


def buy_sell_pressure(df: DataFrame) -> DataFrame:
    """Chart projection: sell volume mirrored below zero, buy volume above,
    and their sum."""
    return df.select(
        "currency", "current_time",
        (-F.col("sell_avg_quantity")).alias("neg_sell_avg_quantity"),
        F.col("buy_avg_quantity"),
        (F.col("buy_avg_quantity") - F.col("sell_avg_quantity")).alias("net_avg_quantity"),
    )


def candle_body(df: DataFrame) -> DataFrame:
    """Signed candle body ``last_cost - first_cost``."""
    return df.select("currency", "current_time",
                     (F.col("last_cost") - F.col("first_cost")).alias("body"))


def corr_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """Upper triangle of the correlation matrix, diagonal included."""
    return list(combinations_with_replacement(columns, 2))


class CoMoments:
    """Pairwise-deletion co-moments of k columns, mergeable: per pair of columns the number of rows that have both, both
    means over those rows, and the centred sums of squares and products."""

    def __init__(self, n, mean, squares, products):
        self.n, self.mean, self.squares, self.products = n, mean, squares, products     # mean[i, j]: of i where j is present

    @staticmethod
    def of(x: np.ndarray) -> CoMoments:
        """Of the rows of ``x``, NaN where missing."""
        here = ~np.isnan(x)
        # about a value of the column first: constant columns have squares of exactly 0
        first = x[here.argmax(axis=0), np.arange(x.shape[1])]
        first = np.where(np.isnan(first), 0.0, first)
        d = np.where(here, x - first, 0.0)
        shift = d.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
        d = np.where(here, d - shift, 0.0)
        m = here.astype(np.float64)
        n = m.T @ m
        some = np.maximum(n, 1)
        off = (d.T @ m) / some                     # what is left of the mean over the rows of a pair
        squares = (d * d).T @ m - n * off * off
        products = d.T @ d - n * off * off.T
        return CoMoments(n, np.where(n > 0, (first + shift)[:, None] + off, 0.0), np.maximum(squares, 0.0), products)

    def merge(self, o: CoMoments) -> CoMoments:
        n = self.n + o.n
        share = np.divide(o.n, n, out=np.zeros_like(n), where=n > 0)
        gap = np.where((self.n > 0) & (o.n > 0), o.mean - self.mean, 0.0)
        weight = self.n * share
        mean = np.where(self.n > 0, self.mean + gap * share, o.mean)
        return CoMoments(n, mean, self.squares + o.squares + gap * gap * weight, self.products + o.products + gap * gap.T * weight)

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.n, self.mean, self.squares, self.products)])

    @staticmethod
    def from_flat(a: np.ndarray, k: int) -> CoMoments:
        return CoMoments(*np.asarray(a, dtype=np.float64).reshape(4, k, k))

    def correlations(self) -> tuple[np.ndarray, np.ndarray]:
        """(r, defined): Pearson's r per pair, NaN for a constant column; defined with two rows or more."""
        across = self.squares * self.squares.T
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.where(across > 0, self.products / np.sqrt(across), np.nan)
        return r, self.n >= 2


HELD_NUMBERS = 8_000_000         # numbers of co-moments that a task holds before it hands them on
SLOTS = 64                       # first merges of a key


def corr_matrix(df: DataFrame, columns: list[str] | None = None,
                key: str = "currency") -> DataFrame:
    """Pearson correlation of every pair of ``columns`` per ``key``, in long
    form ``(key, col_x, col_y, r)`` for the upper triangle with diagonal.

    Pairwise deletion (a row counts for a pair when both values are
    present), as a pandas ``DataFrame.corr`` does.  One scan: every task reduces its
    rows to one :class:`CoMoments` per key, and those are merged by the stable update formula, first in ``SLOTS``
    parts per key, then per key.  Rows without a key are a key of their own.
    """
    columns = columns or [c for c in MEASURE_COLUMNS if c in df.columns]
    k = len(columns)
    key_type = df.schema[key].dataType.simpleString()
    key_arrow = _arrow_type(df, key)
    iu, ju = np.triu_indices(k)

    def partial(batches):
        held: dict = {}
        from pyspark import TaskContext
        slot = TaskContext.get().partitionId() % SLOTS

        def flush():
            rows = list(held.items())
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kv for kv, _ in rows], key_arrow), pa.array([slot] * len(rows), pa.int32()),
                     pa.array([c.flat().tolist() for _, c in rows], pa.list_(pa.float64()))], names=[key, "slot", "moments"])

        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column(0).dictionary_encode("encode")
            names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(k)]).astype(np.float64)
            for code in np.unique(at):
                c = CoMoments.of(x[at == code])
                kv = names[code]
                held[kv] = held[kv].merge(c) if kv in held else c
            if len(held) * 4 * k * k > HELD_NUMBERS:
                yield from flush()
        yield from flush()

    def whole(table: pa.Table) -> CoMoments:
        out = None
        for a in table.column("moments"):
            c = CoMoments.from_flat(a.values.to_numpy(), k)
            out = c if out is None else out.merge(c)
        return out

    def add(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).set_column(2, "moments", pa.array([whole(table).flat().tolist()], pa.list_(pa.float64())))

    def finish(table: pa.Table) -> pa.Table:
        r, defined = whole(table).correlations()
        kv = table.column(0)[0].as_py()
        return pa.table({key: pa.array([kv] * len(iu), key_arrow), "col_x": [columns[i] for i in iu], "col_y": [columns[j] for j in ju],
                         "r": pa.array(r[iu, ju], mask=~defined[iu, ju])})

    schema = f"`{key}` {key_type}, slot int, moments array<double>"
    parts = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(partial, schema)
    return (parts.groupBy(key, "slot").applyInArrow(add, schema)
            .groupBy(key).applyInArrow(finish, f"`{key}` {key_type}, col_x string, col_y string, r double"))


def _arrow_type(df: DataFrame, column: str):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def split_sorted(df: DataFrame, key: str = "currency", order: str = "current_time",
                 index: str = "t") -> DataFrame:
    """Each key's rows ordered by ``order`` and numbered 0..n-1 (the
    distributed form of a dict of per-key sorted frames)."""
    from .ordered import with_series_index
    return with_series_index(df, key, order, index)
