"""Per-symbol time-series analysis, every symbol at once, as Spark jobs.

A series is ``(key, order, value)``; :func:`series` numbers each key's rows
0..n-1 (distributed, see :mod:`.ordered`).  Lags come from chunked windows
with a halo, sums from native aggregates or :func:`.regression.gram`, and
only per-key results of bounded size (a few numbers per lag or model) reach
pandas.  No operator gathers a whole series into one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normal import norm_ppf
from . import regression as R
from .moments import Moments, lag_moments
from .ordered import with_lags, with_series_index


KEYS_BROADCAST = 1_000_000     # per-key rows broadcast at most


def present(c: str) -> Column:
    """True for values that are neither NULL nor NaN."""
    return F.col(c).isNotNull() & ~F.isnan(c)


def series(df: DataFrame, key: str, order: str, value: str, index: str = "t") -> DataFrame:
    """``(key, order, y, t, _n, _mean, _scale)``: the values that are present,
    numbered 0..n-1 per key, with their number, mean and range (1 for a
    constant series)."""
    s = df.select(key, order, F.col(value).cast("double").alias("y"))
    s = with_series_index(s.where(present("y")), key, order, index, totals={
        "_n": (F.count("y"), F.sum), "_sum": (F.sum("y"), F.sum), "_min": (F.min("y"), F.min), "_max": (F.max("y"), F.max)})
    spread = F.col("_max") - F.col("_min")
    return (s.withColumn("_mean", F.col("_sum") / F.col("_n"))
            .withColumn("_scale", F.when(spread > 0, spread).otherwise(F.lit(1.0))).drop("_sum", "_min", "_max"))


def standardised(s: DataFrame) -> DataFrame:
    """``y`` centred and scaled per key, so that regressions on it are well
    conditioned at any price level."""
    return s.withColumn("y", (F.col("y") - F.col("_mean")) / F.col("_scale"))


# ---------------------------------------------------------------------------
# X1 autocorrelation, X2 partial autocorrelation
# ---------------------------------------------------------------------------

def _acf(df: DataFrame, key: str, order: str, value: str, nlags: int) -> DataFrame:
    """``(key, n, lag, acf)``."""
    d = series(df, key, order, value).withColumn("d", F.col("y") - F.col("_mean"))
    lagged = with_lags(d, key, "t", ["d"], list(range(1, nlags + 1)))
    sums = lagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("d") * F.col("d")).alias("c0"),
        *[F.sum(F.col("d") * F.col(f"d_lag{k}")).alias(f"c{k}") for k in range(1, nlags + 1)])
    entries = F.array(*[F.struct(F.lit(k).alias("lag"),
                                 F.try_divide(F.col(f"c{k}"), F.col("c0")).alias("acf"))
                        for k in range(nlags + 1)])
    return sums.select(key, "n", F.inline(entries))


def acf(df: DataFrame, key: str = "currency", order: str = "current_time",
        value: str = "first_cost", nlags: int = 10) -> DataFrame:
    """``(key, lag, acf)`` for lag 0..nlags: sum(d_t d_{t-k}) / sum(d_t^2)
    with d = y - mean(y) (the biased estimator of a standard ACF)."""
    return _acf(df, key, order, value, nlags).drop("n")


# --- fixed value: two-sided 95 % point of the normal distribution ---------------
Z95 = 1.959963984540054


def correlogram(df: DataFrame, key: str = "currency", order: str = "current_time",
                value: str = "first_cost", nlags: int = 10) -> DataFrame:
    """``(key, lag, acf, acf_band, pacf, pacf_band)``: both correlations with the
    half-widths of their 95 % bands.  Bartlett's variance for the ACF,
    (1 + 2 sum_{0<i<k} r_i^2) / n at lag k; 1/n for the PACF; 0 at lag 0."""
    a = _acf(df, key, order, value, nlags)
    before = Window.partitionBy(key).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    square = F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(F.lit(0.0))
    own = F.col("lag") > 0
    a = (a.withColumn("_r2", F.coalesce(F.sum(square).over(before), F.lit(0.0)))
          .withColumn("acf_band", F.when(own, Z95 * F.sqrt((1 + 2 * F.col("_r2")) / F.col("n"))).otherwise(F.lit(0.0)))
          .withColumn("pacf_band", F.when(own, Z95 / F.sqrt("n")).otherwise(F.lit(0.0))))
    p = pacf(a.select(key, "lag", "acf"), key).select(F.col(key).alias("_key"), F.col("lag").alias("_lag"), "pacf")
    return a.join(p, F.col(key).eqNullSafe(F.col("_key")) & (F.col("lag") == F.col("_lag"))).select(
        key, "lag", "acf", "acf_band", "pacf", "pacf_band")


def durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations r[0..L] (r[0] = 1)."""
    L = len(r) - 1
    out = np.full(L + 1, np.nan)
    out[0] = 1.0
    phi = np.zeros(0)
    for k in range(1, L + 1):
        if k == 1:
            pkk = r[1]
            phi = np.array([pkk])
        else:
            num = r[k] - np.dot(phi, r[k - 1:0:-1])
            den = 1.0 - np.dot(phi, r[1:k])
            pkk = num / den if den != 0 else np.nan
            phi = np.append(phi - pkk * phi[::-1], pkk)
        out[k] = pkk
    return out


def pacf(acf_df: DataFrame, key: str = "currency") -> DataFrame:
    """``(key, lag, pacf)`` by Durbin-Levinson on each key's ACF (a group of
    nlags + 1 rows)."""
    key_type = acf_df.schema[key].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        vals = durbin_levinson(pdf["acf"].to_numpy(dtype="float64", na_value=np.nan))
        return pd.DataFrame({key: pdf[key].iloc[0], "lag": pdf["lag"].to_numpy(), "pacf": vals})
    return acf_df.groupBy(key).applyInPandas(run, f"{key} {key_type}, lag int, pacf double")


# ---------------------------------------------------------------------------
# X3 augmented Dickey-Fuller (constant term), lag order by AIC
# ---------------------------------------------------------------------------

# --- fixed values: MacKinnon (2010) critical-value surfaces, constant, N=1 ----
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# --- fixed values: MacKinnon (1994) p-value approximation, constant, N=1 -----
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.83, -1.61
ADF_SMALLP = (2.1659, 1.4412, 0.038269)
ADF_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_crit(nobs: float) -> dict[str, float]:
    return {k: c[0] + c[1] / nobs + c[2] / nobs ** 2 + c[3] / nobs ** 3
            for k, c in ADF_CRIT_C.items()}


def adf_pvalue(stat: float) -> float:
    if stat is None or not np.isfinite(stat):
        return float("nan")
    if stat > ADF_TAU_MAX:
        return 1.0
    if stat < ADF_TAU_MIN:
        return 0.0
    coefs = ADF_SMALLP if stat <= ADF_TAU_STAR else ADF_LARGEP
    z = sum(c * stat ** i for i, c in enumerate(coefs))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def default_maxlag(n: int) -> int:
    """ceil(12 * (n/100)^(1/4)), at most n//2 - 2 (constant-term regression)."""
    return int(min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))


ADF_SCHEMA = ("adf_stat double, pvalue double, usedlag int, nobs long, crit_1pct double, "
              "crit_5pct double, crit_10pct double, icbest double, error string")


ADF_PAIRS = ((0, 0), (0, 1), (1, 1))


def _adf_solver(autolag: str | None):
    def solve(kv: tuple, m: Moments) -> list[dict]:
        ml, scale = int(kv[1]), kv[2]
        lag, icbest = max(ml, 0), None
        if autolag:
            lag = -1
            g = m.unit_root_gram(ml, ml + 1) if ml >= 0 else None      # the sample that all lags share
            for k in range(max(ml, -1) + 1):
                fit = R.ols(g, list(range(2 + k)), ml + 2)
                if "error" in fit:
                    continue
                aic = R.gaussian_aic(fit["ssr"], fit["nobs"], fit["k"])
                if lag < 0 or aic < icbest:
                    lag, icbest = k, aic
            if lag >= 0:
                # in the units of the series: ssr grows with the square of the scale
                icbest += 2 * g[0, 0] * math.log(scale)
            lag = max(lag, 0)                     # a series too short for any fit keeps a row
        g = m.unit_root_gram(lag, lag + 1)
        fit = R.ols(g, list(range(2 + lag)), lag + 2)
        nobs = int(g[0, 0])
        error = fit.get("error")
        sigma2 = None if error else fit["ssr"] / (fit["nobs"] - fit["k"])
        if not error and sigma2 <= 0:
            error = "perfect fit"
        crit = adf_crit(nobs) if nobs > 0 else {"1%": None, "5%": None, "10%": None}
        stat = None if error else float(fit["b"][1] / math.sqrt(sigma2 * fit["inv"][1, 1]))
        return [{"adf_stat": stat, "pvalue": None if error else adf_pvalue(stat), "usedlag": lag, "nobs": nobs, "crit_1pct": crit["1%"],
                 "crit_5pct": crit["5%"], "crit_10pct": crit["10%"], "icbest": icbest, "error": error}]
    return solve


def adf(df: DataFrame, key: str = "currency", order: str = "current_time",
        value: str = "first_cost", maxlag: int | None = None, autolag: str | None = "AIC") -> DataFrame:
    """ADF regression ``dy_t = c + b*y_{t-1} + sum_i g_i*dy_{t-i}``, test
    statistic = t of b.  With ``autolag='AIC'`` every lag 0..maxlag is fitted
    on the common sample and the least-AIC lag is refitted on its full
    sample; otherwise ``maxlag`` lags are used.

    All fits of a key come from its lag moments (:mod:`.moments`), taken in one pass over the rows.
    """
    s = standardised(series(df, key, order, value))
    ml = (F.lit(maxlag) if maxlag is not None else F.least(
        F.ceil(F.lit(12.0) * F.pow(F.col("_n") / 100.0, 0.25)), F.floor(F.col("_n") / 2) - 2)).cast("int")
    key_type = df.schema[key].dataType.simpleString()
    out = lag_moments(s.withColumn("_ml", ml), [key, "_ml", "_scale"], "t", "y", ADF_PAIRS, lambda kv: max(int(kv[1]), 0) + 1,
                      _adf_solver(autolag), f"{key} {key_type}, _ml int, _scale double, {ADF_SCHEMA}")
    return out.drop("_ml", "_scale")


# ---------------------------------------------------------------------------
# X4 normal Q-Q points
# ---------------------------------------------------------------------------

def qq_points(df: DataFrame, key: str = "currency", value: str = "first_cost") -> DataFrame:
    """Sorted sample against normal quantiles at plotting positions
    i/(n+1), with the standardized reference line z*std + mean."""
    s = df.select(key, F.col(value).cast("double").alias("sample")).where(present("sample"))
    # variance from the partitions' counts, means and centred squares
    ranked = with_series_index(s, key, "sample", "_r", totals={
        "_n": (F.count("sample"), F.sum), "_sum": (F.sum("sample"), F.sum),
        "_moments": (F.struct(F.count("sample").alias("n"), F.avg("sample").alias("m"), F.var_pop("sample").alias("v")), F.collect_list)})
    ranked = ranked.withColumn("_mu", F.col("_sum") / F.col("_n"))
    m = F.col("_mu")
    ranked = ranked.withColumn("_sd", F.sqrt(F.aggregate("_moments", F.lit(0.0), lambda a, x: a + x["n"] * (x["v"] + (x["m"] - m) * (x["m"] - m)))
                                             / F.col("_n")))
    p = (F.col("_r") + 1) / (F.col("_n") + 1)
    z = norm_ppf(p)
    return ranked.select(
        key, (F.col("_r") + 1).alias("i"), p.alias("p"), z.alias("z"), "sample",
        (z * F.col("_sd") + F.col("_mu")).alias("fit"))


# ---------------------------------------------------------------------------
# X7 sliding feature windows, X8 per-feature linear autoregression
# ---------------------------------------------------------------------------

def lag_features(df: DataFrame, features: list[str], win: int, key: str = "currency",
                 order: str = "current_time") -> DataFrame:
    """For every row with ``win - 1`` predecessors: the window of the last
    ``win`` values of each feature, as columns ``{f}_lag{k}`` (k = 0 is the
    row itself)."""
    s = with_series_index(df.select(key, order, *features), key, order, "t")
    lagged = with_lags(s, key, "t", features, list(range(1, win)))
    return lagged.where(F.col("t") >= win - 1).select(
        key, "t", order,
        *[F.col(f).alias(f"{f}_lag0") for f in features],
        *[F.col(f"{f}_lag{k}") for f in features for k in range(1, win)])


def ar_linear(df: DataFrame, features: list[str], win: int, key: str = "currency",
              order: str = "current_time") -> DataFrame:
    """Per key and feature, least squares of ``f_t`` on ``1, f_{t-1} ..
    f_{t-win}``: ``(key, feature, term, coef)`` plus ``r2`` and ``nobs`` on
    every row (term 0 = intercept)."""
    def value(f):       # a NaN is a missing value
        return F.when(present(f), F.col(f).cast("double"))

    totals: dict = {}
    for i, f in enumerate(features):
        totals |= {f"_n{i}": (F.count(f), F.sum), f"_s{i}": (F.sum(f), F.sum), f"_lo{i}": (F.min(f), F.min), f"_hi{i}": (F.max(f), F.max)}
    s = with_series_index(df.select(key, order, *[value(f).alias(f) for f in features]), key, order, "t", totals=totals)
    for i, f in enumerate(features):
        spread = F.col(f"_hi{i}") - F.col(f"_lo{i}")
        s = (s.withColumn(f"_m{i}", F.coalesce(F.try_divide(F.col(f"_s{i}"), F.col(f"_n{i}")), F.lit(0.0)))
             .withColumn(f"_r{i}", F.when(spread > 0, spread).otherwise(F.lit(1.0)))
             .withColumn(f, (F.col(f) - F.col(f"_m{i}")) / F.col(f"_r{i}")).drop(f"_n{i}", f"_s{i}", f"_lo{i}", f"_hi{i}"))
    lagged = with_lags(s, key, "t", features, list(range(1, win + 1)))
    stacked = lagged.select(key, "t", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_m{i}").alias("_m"), F.col(f"_r{i}").alias("_s"), F.col(f).alias("v"),
                 *[F.col(f"{f}_lag{k}").alias(f"l{k}") for k in range(1, win + 1)])
        for i, f in enumerate(features)])).alias("_x")).select(key, "t", "_x.*")
    sample = (F.col("t") >= win) & F.col("v").isNotNull()
    for k in range(1, win + 1):
        sample = sample & F.col(f"l{k}").isNotNull()
    cols = ["c"] + [f"l{k}" for k in range(1, win + 1)] + ["v"]
    keys = [key, "feature", "_m", "_s"]
    g = R.gram(stacked.withColumn("c", F.lit(1.0)), keys, cols, where=sample)
    K, Y = len(cols), len(cols) - 1

    def fit(kv, gm):
        res = R.ols(gm, list(range(win + 1)), Y)
        if "error" in res:
            return [{"term": -1, "coef": None, "r2": None, "nobs": int(gm[0, 0]), "error": res["error"]}]
        n, b = res["nobs"], res["b"].copy()
        ybar = gm[0, Y] / n
        sst = gm[Y, Y] - n * ybar * ybar
        r2 = 1 - res["ssr"] / sst if sst > 0 else None
        # back to the feature's own units: slopes stay, the constant moves
        b[0] = kv[2] * (1 - b[1:].sum()) + kv[3] * b[0]
        return [{"term": i, "coef": float(x), "r2": r2, "nobs": int(n), "error": None} for i, x in enumerate(b)]
    key_type = df.schema[key].dataType.simpleString()
    return R.solve_grouped(g, keys, K, fit,
                           f"{key} {key_type}, feature string, _m double, _s double, term int, coef double, "
                           "r2 double, nobs long, error string").drop("_m", "_s")
