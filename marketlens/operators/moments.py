"""Lag moments of long series, in one pass and without lag columns.

A regression on the lags of a series needs only sums of products ``w_t * w_{t-k}`` and a few values at both
ends: all entries of X'X for lag order m follow from them by

    M[i+1, j+1] = M[i, j] + w[s-1-i] w[s-1-j] - w[n-1-i] w[n-1-j].

So a task walks its rows once and keeps, per run of consecutive rows of a key, one :class:`Run`: the number of
rows, their sum, the first and last values (its edges), and the lag products inside the run.
Neighbouring runs merge from their edges alone, in any grouping, so a symbol's rows are spread over
as many tasks as they fill, and what is shuffled is a few numbers per lag and task.  The width of the plan does not
depend on the lag order; every key has its own.

Products are taken of differences of chosen orders, not assembled from products of levels, so series
with small steps around a high level lose no digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

Pairs = tuple[tuple[int, int], ...]


def differences(y: np.ndarray, orders) -> dict[int, np.ndarray]:
    """Differences of each order, aligned with ``y``; the first d values of order d are 0."""
    out, w = {}, y
    for d in range(max(orders) + 1):
        if d:
            w = np.concatenate([[0.0], np.diff(w)])
            w[:d] = 0.0
        if d in orders:
            out[d] = w
    return out


def _sums(y: np.ndarray, pairs: Pairs, lags: int, lo: int | None = None, hi: Callable[[int], int] | None = None) -> np.ndarray:
    """(pairs, lags + 1): sums of wa[t] * wb[t - k] over the t whose values all lie in ``y``; with ``lo`` only
    over t from it up to ``hi(reach)``."""
    out = np.zeros((len(pairs), lags + 1))
    if not len(y):
        return out
    w = differences(y, {d for p in pairs for d in p})
    for i, (a, b) in enumerate(pairs):
        wa, wb = w[a], w[b]
        for k in range(lags + 1):
            reach = max(a, k + b)
            first = reach if lo is None else max(reach, lo)
            last = len(y) if lo is None else min(len(y), hi(reach))
            if first < last:
                out[i, k] = wa[first:last] @ wb[first - k:last - k]
    return out


@dataclass
class Run:
    """Consecutive rows of one series."""

    start: int
    n: int
    total: float
    head: np.ndarray
    tail: np.ndarray
    products: np.ndarray       # (pairs, lags + 1)

    @staticmethod
    def of(start: int, y: np.ndarray, pairs: Pairs, lags: int) -> Run:
        edge = edge_length(pairs, lags)
        return Run(start, len(y), float(y.sum()), y[:edge].copy(), y[-edge:].copy(), _sums(y, pairs, lags))

    def merge(self, after: Run, pairs: Pairs, lags: int) -> Run:
        """This run and the one right behind it."""
        edge = edge_length(pairs, lags)
        left = self.tail[-edge:]
        both = np.concatenate([left, after.head[:edge]])
        mid = len(left)
        # products whose later value lies behind the seam and whose earliest lies before it
        seam = _sums(both, pairs, lags, lo=mid, hi=lambda reach: mid + reach)
        return Run(self.start, self.n + after.n, self.total + after.total,
                   np.concatenate([self.head, after.head])[:edge] if len(self.head) < edge else self.head,
                   np.concatenate([self.tail, after.tail])[-edge:] if len(after.tail) < edge else after.tail,
                   self.products + after.products + seam)


def edge_length(pairs: Pairs, lags: int) -> int:
    return lags + max(d for p in pairs for d in p) + 2


class Moments:
    """The whole series of a key, as far as regressions on its lags can see it."""

    def __init__(self, run: Run, pairs: Pairs, lags: int):
        self.run, self.pairs, self.lags, self.n = run, pairs, lags, run.n
        orders = {d for p in pairs for d in p}
        self._head = differences(run.head, range(max(orders) + 1))
        self._tail = differences(run.tail, range(max(orders) + 1))

    def at(self, d: int, t: int) -> float:
        """Value t of the d-th difference; t is near one of the ends."""
        if t < len(self.run.head):
            return self._head[d][t]
        return self._tail[d][t - self.n + len(self.run.tail)]

    def _span(self, d: int, lo: int, hi: int) -> np.ndarray:
        return np.array([self.at(d, t) for t in range(lo, hi)])

    def sum(self, d: int, lo: int, hi: int) -> float:
        """Sum of the d-th difference over lo <= t < hi."""
        if hi <= lo:
            return 0.0
        if d:
            return self.at(d - 1, hi - 1) - self.at(d - 1, lo - 1)
        return self.run.total - self._span(0, 0, lo).sum() - self._span(0, hi, self.n).sum()

    def product(self, a: int, b: int, k: int, lo: int, hi: int) -> float:
        """Sum of wa[t] * wb[t - k] over lo <= t < hi."""
        if hi <= lo:
            return 0.0
        first = max(a, k + b)
        whole = self.run.products[self.pairs.index((a, b)), k]
        before = range(first, lo)
        behind = range(max(hi, first), self.n)
        return whole - sum(self.at(a, t) * self.at(b, t - k) for t in before) - sum(self.at(a, t) * self.at(b, t - k) for t in behind)

    def lag_gram(self, d: int, m: int, s: int) -> np.ndarray:
        """Gram matrix of 1, w[t-1] .. w[t-m], w[t] over t = s .. n-1, w the d-th difference, s >= d + m."""
        g = np.zeros((m + 2, m + 2))
        rows = self.n - s
        if rows <= 0:
            return g
        M = np.zeros((m + 1, m + 1))
        M[0] = [self.product(d, d, k, s, self.n) for k in range(m + 1)]
        first, last = self._span(d, s - m, s)[::-1], self._span(d, self.n - m, self.n)[::-1]
        for i in range(m):
            M[i + 1, i + 1:] = M[i, i:m] + first[i] * first[i:] - last[i] * last[i:]
        M = np.triu(M) + np.triu(M, 1).T
        sums = np.array([self.sum(d, s - j, self.n - j) for j in range(m + 1)])
        order = [*range(1, m + 1), 0]                    # lags, then the response
        g[0, 0] = rows
        g[0, 1:] = g[1:, 0] = sums[order]
        g[1:, 1:] = M[np.ix_(order, order)]
        return g

    def unit_root_gram(self, lag: int, s: int) -> np.ndarray:
        """Gram matrix of 1, y[t-1], dy[t-1] .. dy[t-lag], dy[t] over t = s .. n-1, s >= lag + 1."""
        n, k = self.n, lag + 3
        g = np.zeros((k, k))
        if n - s <= 0:
            return g
        d = self.lag_gram(1, lag, s)
        at = [0, *range(2, k)]
        g[np.ix_(at, at)] = d
        g[0, 1] = g[1, 0] = self.sum(0, s - 1, n - 1)
        g[1, 1] = self.product(0, 0, 0, s - 1, n - 1)
        for i in range(1, lag + 1):
            g[1, 1 + i] = g[1 + i, 1] = self.product(0, 1, i - 1, s - 1, n - 1)
        g[1, k - 1] = g[k - 1, 1] = self.product(0, 1, 0, s, n) - g[k - 1, k - 1]
        return g


ROWS = "_start bigint, _rows bigint, _total double, _head array<double>, _tail array<double>, _products array<double>"


def _runs(batches, keys: int, pairs: Pairs, lags_of: Callable[[tuple], int]):
    """Arrow batches (keys..., t, y) -> one row per run of consecutive rows."""
    current: tuple | None = None
    run: Run | None = None

    def row(kv, r):
        return (*kv, r.start, r.n, r.total, r.head.tolist(), r.tail.tolist(), r.products.ravel().tolist())

    for b in batches:
        if not b.num_rows:
            continue
        kvs = list(zip(*(b.column(i).to_pylist() for i in range(keys))))
        t = b.column(keys).to_numpy(zero_copy_only=False)
        y = b.column(keys + 1).to_numpy(zero_copy_only=False).astype(np.float64)
        new = np.flatnonzero(np.diff(t) != 1) + 1
        edges = sorted({0, len(t), *new.tolist(), *(i for i in range(1, len(kvs)) if kvs[i] != kvs[i - 1])})
        out = []
        for lo, hi in zip(edges, edges[1:]):
            kv, lags = kvs[lo], lags_of(kvs[lo])
            part = Run.of(int(t[lo]), y[lo:hi], pairs, lags)
            if run is not None and kv == current and run.start + run.n == part.start:
                run = run.merge(part, pairs, lags)
                continue
            if run is not None:
                out.append(row(current, run))
            current, run = kv, part
        yield from out
    if run is not None:
        yield row(current, run)


def lag_moments(df: DataFrame, keys: list[str], index: str, value: str, pairs: Pairs, lags_of: Callable[[tuple], int],
                solver: Callable[[tuple, Moments], list[dict]], schema: str) -> DataFrame:
    """``solver(key values, moments)`` of every key of ``df``, whose rows are numbered 0..n-1 per key by ``index``.

    ``keys`` are the key and columns that are constant in it; ``lags_of`` gives a key's lag order from them.  Rows
    in order of the index make few runs; any order gives the same sums."""
    types = dict(df.dtypes)
    key_schema = ", ".join(f"`{c}` {types[c]}" for c in keys)
    names = [*keys, *(c.split()[0] for c in ROWS.split(", "))]
    arrow = [f.type for f in _arrow_schema(df, keys)] + [pa.int64(), pa.int64(), pa.float64(), *[pa.list_(pa.float64())] * 3]

    def run(batches):
        rows = list(_runs(batches, len(keys), pairs, lags_of))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), ty) for c, ty in zip(zip(*rows), arrow)], names=names)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_start")
        kv = tuple(None if pd.isna(x) else x for x in (pdf[c].iloc[0] for c in keys))
        lags = lags_of(kv)
        whole: Run | None = None
        for r in pdf[names[len(keys):]].itertuples(index=False):
            part = Run(int(r[0]), int(r[1]), float(r[2]), *(np.array(x, dtype=float) for x in r[3:5]),
                       np.array(r[5], dtype=float).reshape(len(pairs), lags + 1))
            whole = part if whole is None else whole.merge(part, pairs, lags)
        out = pd.DataFrame(solver(kv, Moments(whole, pairs, lags)))
        for c in keys:
            out[c] = pdf[c].iloc[0]
        return out

    parts = df.select(*keys, index, value).mapInArrow(run, f"{key_schema}, {ROWS}")
    return parts.groupBy(*keys).applyInPandas(solve, schema)


def _arrow_schema(df: DataFrame, keys: list[str]):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df.select(*keys).schema)
