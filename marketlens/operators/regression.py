"""Distributed least squares by normal equations.

:func:`gram` sums ``x_i * x_j`` for all column pairs per key: every
partition reduces its rows to one small matrix per key (numpy inside
``mapInPandas``), and a ``groupBy(key, i, j)`` adds the partials.  The
shuffle carries ``k(k+1)/2`` numbers per key and partition, whatever the row
count, and no key's rows ever meet in one task.  :func:`solve_grouped` then
hands each key's (small) matrix to a solver in ``applyInPandas``.

Callers select the rows a model uses and bring the columns to unit scale per
key (prices at 60,000 and at 2e-6 alike); a NULL or NaN inside a selected row
is an error of the caller and makes that key's sums NaN, never 0.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MAX_CONDITION = 1e13     # of the design with columns of unit length
HELD_NUMBERS = 8_000_000     # numbers of matrices that a task holds before it hands them on
PERFECT = 1e-14          # share of y'y below which residuals are rounding noise


def gram(df: DataFrame, keys: list[str], cols: list[str], where: Column | None = None) -> DataFrame:
    """``(keys..., i, j, s)`` with ``s = sum(col_i * col_j)`` for ``i <= j``.

    ``where`` selects the sample rows; rows outside it contribute zeros, so
    a key without any sample row still gets an (all-zero) matrix and its
    solver can report why no fit exists instead of the key vanishing.
    """
    k, masked = len(cols), where is not None
    iu, ju = np.triu_indices(k)
    key_schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches):
        acc: dict = {}

        def flush():
            for kv, m in acc.items():
                out = {c: v for c, v in zip(keys, kv)}
                out.update({"i": iu.astype("int32"), "j": ju.astype("int32"), "s": m[iu, ju]})
                yield pd.DataFrame(out)
            acc.clear()

        for pdf in batches:
            for kv, g in pdf.groupby(keys, sort=False, dropna=False):
                x = g[cols].to_numpy(dtype="float64", na_value=np.nan)
                if masked:
                    x = x[g["_in"].to_numpy(dtype=bool)]
                m = x.T @ x
                acc[kv] = acc[kv] + m if kv in acc else m
            if len(acc) * k * k > HELD_NUMBERS:       # many keys: hand their matrices on
                yield from flush()
        yield from flush()

    data = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols],
                     *([F.coalesce(where, F.lit(False)).alias("_in")] if masked else []))
    partial = data.mapInPandas(run, f"{key_schema}, i int, j int, s double")
    return partial.groupBy(*keys, "i", "j").agg(F.sum("s").alias("s"))


def to_matrix(pdf: pd.DataFrame, k: int) -> np.ndarray:
    g = np.zeros((k, k))
    i, j, s = pdf["i"].to_numpy(), pdf["j"].to_numpy(), pdf["s"].to_numpy()
    g[i, j] = s
    g[j, i] = s
    return g


def solve_grouped(g: DataFrame, keys: list[str], k: int,
                  solver: Callable[[tuple, np.ndarray], list[dict]], schema: str) -> DataFrame:
    """Apply ``solver(key_values, G)`` to each key's k x k Gram matrix; each
    group holds k(k+1)/2 rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kv = tuple(pdf[c].iloc[0] for c in keys)
        rows = solver(kv, to_matrix(pdf, k))
        out = pd.DataFrame(rows)
        for c, v in zip(keys, kv):
            out[c] = v
        return out
    return g.groupBy(*keys).applyInPandas(run, schema)


def ols(g: np.ndarray, xs: list[int], y: int, n_idx: int = 0) -> dict:
    """OLS from a Gram matrix: ``xs`` regressor indices (``n_idx`` = the
    constant column, whose self-product is the row count), ``y`` response.
    Returns coefficients, ssr, nobs, k and (X'X)^-1, or ``error``."""
    xtx = g[np.ix_(xs, xs)]
    xty = g[xs, y]
    nobs = g[n_idx, n_idx]
    k = len(xs)
    if nobs <= k:
        return {"error": "too few observations", "nobs": nobs, "k": k}
    norm = np.sqrt(np.diag(xtx))
    if not np.all(np.isfinite(xtx)) or not np.all(np.isfinite(xty)) or np.any(norm <= 0):
        return {"error": "singular design", "nobs": nobs, "k": k}
    # rank is judged on columns of unit length, whatever their units
    unit = xtx / np.outer(norm, norm)
    if np.linalg.cond(unit) > MAX_CONDITION:
        return {"error": "singular design", "nobs": nobs, "k": k}
    inv = np.linalg.inv(unit) / np.outer(norm, norm)
    b = np.linalg.solve(unit, xty / norm) / norm
    # y'y - 2 b'X'y + b'X'X b: stays accurate when b is not exactly the minimum
    ssr = max(float(g[y, y] - 2 * (b @ xty) + b @ xtx @ b), 0.0)
    if ssr <= PERFECT * max(float(g[y, y]), 0.0):
        ssr = 0.0
    return {"b": b, "ssr": ssr, "nobs": nobs, "k": k, "inv": inv}


def gaussian_aic(ssr: float, nobs: float, k: int) -> float:
    """AIC of a Gaussian linear model with k regressors:
    nobs*(log(2*pi) + log(ssr/nobs) + 1) + 2k."""
    if ssr <= 0:
        return float("-inf")
    return float(nobs * (np.log(2 * np.pi) + np.log(ssr / nobs) + 1) + 2 * k)
