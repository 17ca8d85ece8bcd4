"""ARIMA(p, d, q) order search and forecasts by Hannan-Rissanen regressions,
the exact Gaussian likelihood of the fitted models, and fits that maximise it.

For every key and differencing order d the series w = (1-B)^d y is fitted by

1. a long autoregression AR(m) of w (m = max(floor(log(n)^2), 2*max(P, Q))): its normal equations are
   assembled from the lag moments of the series (:mod:`.moments`), taken for all d in one pass;
2. a regression of w_t on w_{t-1..t-P} and e_{t-1..t-Q}, e the residuals of the long AR (plus a constant when
   d = 0), over one sample that is common to all (p, d, q) of the key; every
   (p, q) model of the grid is a sub-regression of that one design.  Tasks walk index chunks with a halo of
   m rows, compute w and e as arrays and return Gram matrices only, so no design is written and
   no lag column exists;
3. AIC = -2 * Gaussian conditional log-likelihood + 2 * (#coefficients + 1).

Models are accepted only with at least ``OBS_PER_COEF`` observations per
coefficient and with all roots of the AR and the MA polynomial outside the
unit circle: an accepted forecast then grows at most as a polynomial of
degree d.  Regressions run on values centred and scaled per key; results are
in the units of the series.

The exact likelihood of a fitted model is the Kalman filter's.  Its gains and innovation variances do not depend on the
data, and given them a chunk of rows maps the state at its start to the state at its end by an affine function, and the
state at its start to its sum of squared innovations by a quadratic one.  Every chunk
returns those small matrices for all models of its key, a slice of them at a time; they are composed in order (:func:`carry`), so
the recursion over a symbol's rows runs in as many tasks as it has chunks.  :func:`arima_mle` climbs this
likelihood from the regression estimates, all keys and models together, one pass over the rows per step.

The per-key solves see only Gram matrices, and the forecast recursion sees only
each key's last max(p, d, q) + 1 rows.  Fits that cannot be made (too few
observations, singular design) are rows with a ``status``, not silent gaps.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from . import regression as R
from .moments import Moments, differences, lag_moments
from .ordered import in_chunks
from .series import series, standardised

OBS_PER_COEF = 3
ROOT_MARGIN = 1e-6      # roots this close to the unit circle are not outside
CHUNK_ROWS = 200_000
SLICE = 16              # models of a key that are filtered together
SETTLED = 1e-15         # relative change of a state variance that no longer counts
STATE_MAX = 1e12        # stationary variance, in innovation variances, up to which a double holds the filter

GRID_SCHEMA = ("p int, q int, aic double, sigma2 double, nobs long, const double, "
               "ar array<double>, ma array<double>, status string, _const double")
PER_KEY = ["_n", "_m", "_mean", "_scale"]


def outside_unit_circle(coef: list[float], sign: float) -> bool:
    """Whether all roots of 1 + sign * (c_1 z + c_2 z^2 + ...) lie outside the unit circle."""
    c = np.array([sign * x for x in coef][::-1] + [1.0])
    c = c[np.argmax(c != 0):]
    return len(c) < 2 or bool(np.all(np.abs(np.roots(c)) > 1 + ROOT_MARGIN))


def _prepare(df: DataFrame, key: str, order: str, value: str, P: int, D: int, Q: int) -> tuple[DataFrame, DataFrame]:
    """(rows, per key): the standardised series with ``PER_KEY``, and one row per key with its long
    autoregressions ``a`` (coefficients per d, null where there is no fit)."""
    s = standardised(series(df, key, order, value)).withColumn("_m", F.greatest(
        F.floor(F.pow(F.log(F.col("_n").cast("double")), 2)), F.lit(2 * max(P, Q))).cast("int"))
    pairs = tuple((d, d) for d in range(D + 1))

    def long_ar(kv: tuple, mo: Moments) -> list[dict]:
        m, a = int(kv[2]), []
        for d in range(D + 1):
            fit = R.ols(mo.lag_gram(d, m, d + m), list(range(m + 1)), m + 1) if mo.n > d + m else {"error": "too few observations"}
            a.append(None if "error" in fit else fit["b"].tolist())
        return [{"a": a}]

    types = dict(s.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in [key, *PER_KEY]) + ", a array<array<double>>"
    fits = lag_moments(s, [key, *PER_KEY], "t", "y", pairs, lambda kv: int(kv[2]), long_ar, schema)
    return s.select(key, "t", "y", *PER_KEY), session.materialise(fits, "arima-long-ar")


def _chunk(left: pa.Table) -> tuple[np.ndarray, int, int]:
    """(y, index of its first value, index of the first own row) of a chunk, in order."""
    t, y = left.column("t").to_numpy(), left.column("y").to_numpy()
    order = np.argsort(t, kind="stable")
    return y[order].astype(np.float64), int(t[order[0]]), left.column("_part_start")[0].as_py()


def _innovations(y: np.ndarray, t0: int, d: int, a) -> tuple[np.ndarray, np.ndarray]:
    """(w, e): the d-th difference and its residuals from AR coefficients ``a``; NaN where they are not defined."""
    w = differences(y, [d])[d]
    m = len(a) - 1
    w[:d] = np.nan
    e = np.full(len(w), np.nan)
    first = d + m                       # in the array: all lags are inside
    if len(w) > first:
        e[first:] = w[first:] - a[0] - (np.convolve(w[d:-1], a[1:], "valid") if m else 0.0)
    return w, e


def _lagged(x: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(x), np.nan)
    out[k:] = x[:len(x) - k] if k else x
    return out


def _grid_rows(P: int, Q: int):
    cols2 = ["c"] + [f"w_lag{i}" for i in range(1, P + 1)] + [f"e_lag{j}" for j in range(1, Q + 1)] + ["w"]
    Y = len(cols2) - 1

    def solve(kv, g):
        d, mean, scale = int(kv[1]), kv[2], kv[3]
        out = []
        nobs = g[0, 0]
        for p in range(P + 1):
            for q in range(Q + 1):
                xs = ([0] if d == 0 else []) + list(range(1, p + 1)) + [P + j for j in range(1, q + 1)]
                row = {"p": p, "q": q, "aic": None, "sigma2": None, "nobs": int(nobs), "const": None,
                       "ar": None, "ma": None, "status": "ok", "_const": None}
                if nobs < OBS_PER_COEF * (len(xs) + 1):
                    row["status"] = "too few observations"
                    out.append(row)
                    continue
                if xs:
                    fit = R.ols(g, xs, Y)
                    if "error" in fit:
                        row["status"] = fit["error"]
                        out.append(row)
                        continue
                    b, ssr = fit["b"], fit["ssr"]
                else:
                    b, ssr = np.zeros(0), float(g[Y, Y])
                if nobs <= 0 or ssr <= 0:
                    row["status"] = "degenerate fit"
                    out.append(row)
                    continue
                off = 1 if d == 0 else 0
                ar, ma = [float(x) for x in b[off:off + p]], [float(x) for x in b[off + p:off + p + q]]
                if not outside_unit_circle(ar, -1):
                    row["status"] = "not stationary"
                elif not outside_unit_circle(ma, 1):
                    row["status"] = "not invertible"
                sigma2 = ssr / nobs * scale * scale
                llf = -0.5 * nobs * (math.log(2 * math.pi * sigma2) + 1)
                const = float(b[0]) if d == 0 else 0.0
                row.update(aic=float(-2 * llf + 2 * (len(xs) + 1)), sigma2=float(sigma2),
                           const=mean * (1 - sum(ar)) + scale * const if d == 0 else 0.0, _const=const,
                           ar=ar, ma=ma)
                out.append(row)
        return out
    return cols2, solve


def _grams(rows: DataFrame, per_key: DataFrame, key: str, P: int, D: int, Q: int, chunk_rows: int) -> DataFrame:
    """(key, d, _mean, _scale, i, j, s): Gram matrices of the second regression."""
    k = P + Q + 2
    iu, ju = np.triu_indices(k)
    types = dict(rows.dtypes)
    key_arrow = rows.schema[key]

    def part(left: pa.Table, right: pa.Table) -> pa.Table:
        y, t0, start = _chunk(left)
        m, fits = right.column("_m")[0].as_py(), right.column("a")[0].as_py()
        t = t0 + np.arange(len(y))
        sample = (t >= start) & (t >= D + m + Q)
        out = []
        for d in range(D + 1):
            g = np.zeros((k, k))
            if fits[d] is not None and sample.any():
                w, e = _innovations(y, t0, d, np.array(fits[d]))
                x = np.column_stack([np.ones(len(w)), *[_lagged(w, i) for i in range(1, P + 1)], *[_lagged(e, j) for j in range(1, Q + 1)], w])[sample]
                g = x.T @ x
            out.append(g[iu, ju])
        n = len(iu) * (D + 1)
        same = {c: pa.array([right.column(c)[0].as_py()] * n, right.schema.field(c).type) for c in (key, "_mean", "_scale")}
        return pa.table({key: same[key], "d": pa.array(np.repeat(np.arange(D + 1), len(iu)).astype(np.int32)), "_mean": same["_mean"], "_scale": same["_scale"],
                         "i": pa.array(np.tile(iu, D + 1).astype(np.int32)), "j": pa.array(np.tile(ju, D + 1).astype(np.int32)),
                         "s": pa.array(np.concatenate(out))})

    schema = f"`{key_arrow.name}` {types[key]}, d int, _mean double, _scale double, i int, j int, s double"
    partial = in_chunks(rows, per_key, key, "t", "_n", F.col("_m") + F.lit(D + Q), part, schema, chunk_rows)
    return partial.groupBy(key, "d", "_mean", "_scale", "i", "j").agg(F.sum("s").alias("s"))


def _fits(df, key, order, value, P, D, Q, chunk_rows):
    rows, per_key = _prepare(df, key, order, value, P, D, Q)
    cols2, solve = _grid_rows(P, Q)
    key_type = df.schema[key].dataType.simpleString()
    fits = R.solve_grouped(_grams(rows, per_key, key, P, D, Q, chunk_rows), [key, "d", "_mean", "_scale"], len(cols2), solve,
                           f"{key} {key_type}, d int, _mean double, _scale double, {GRID_SCHEMA}")
    ok = F.col("status") == "ok"
    w = Window.partitionBy(key).orderBy(F.when(ok, F.col("aic")).asc_nulls_last(), "p", "d", "q")
    return fits.withColumn("best", (F.row_number().over(w) == 1) & ok), rows, per_key


def arima_fits(df: DataFrame, key: str = "currency", order: str = "current_time",
               value: str = "first_cost", max_p: int = 4, max_d: int = 4, max_q: int = 4, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every (p, d, q) fit with its coefficients; ``best`` marks the least AIC among successful fits."""
    return _fits(df, key, order, value, max_p, max_d, max_q, chunk_rows)[0]


def arima_grid(df: DataFrame, key: str = "currency", order: str = "current_time",
               value: str = "first_cost", max_p: int = 4, max_d: int = 4, max_q: int = 4) -> DataFrame:
    """AIC of every ARIMA(p, d, q), 0 <= p, d, q <= 4 by default, per key;
    ``best`` marks the least AIC among successful fits."""
    fits = arima_fits(df, key, order, value, max_p, max_d, max_q)
    return fits.select(key, "p", "d", "q", "aic", "sigma2", "nobs", "status", "best")


def arima_forecast(df: DataFrame, key: str = "currency", order: str = "current_time",
                   value: str = "first_cost", horizon: int = 1000,
                   max_p: int = 4, max_d: int = 4, max_q: int = 4, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Fitted values and residuals of each key's best model on its sample,
    then ``horizon`` forecasts beyond the last observation.

    Output ``(key, t, kind, y, fitted, resid)``; kind is ``fit`` or
    ``forecast``.
    """
    fits, rows, per_key = _fits(df, key, order, value, max_p, max_d, max_q, chunk_rows)
    best = fits.where("best").select(F.col(key).alias("_key"), "d", "p", "q", F.col("_const").alias("const"), "ar", "ma")
    best = session.materialise(per_key.join(best, F.col(key).eqNullSafe(F.col("_key"))).drop("_key"), "arima-best")
    key_type = df.schema[key].dataType.simpleString()

    def residuals(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:            # a key without an accepted model
            return left.slice(0, 0).select([key, "t", "y"]).append_column("w", pa.array([], pa.float64())).append_column("resid", pa.array([], pa.float64()))
        y, t0, start = _chunk(left)
        own = right.slice(0, 1).to_pylist()[0]
        d, p, q, m = own["d"], own["p"], own["q"], own["_m"]
        t = t0 + np.arange(len(y))
        w, e = _innovations(y, t0, d, np.array(own["a"][d]))
        fitted = own["const"] + sum((own["ar"][i] * _lagged(w, i + 1) for i in range(p)), np.zeros(len(w))) \
            + sum((own["ma"][j] * _lagged(e, j + 1) for j in range(q)), np.zeros(len(w)))
        resid = np.where(t >= d + m + q, w - fitted, np.nan)
        keep = t >= start
        missing = [np.isnan(x[keep]) for x in (w, resid)]
        keys = pa.array([own[key]] * int(keep.sum()), right.schema.field(key).type)
        return pa.table({key: keys, "t": pa.array(t[keep]), "y": pa.array(y[keep]), "w": pa.array(w[keep], mask=missing[0]),
                         "resid": pa.array(resid[keep], mask=missing[1])})

    fitted = in_chunks(rows, best, key, "t", "_n", F.col("_m") + F.lit(max_d + max_q), residuals,
                       f"`{key}` {key_type}, t long, y double, w double, resid double", chunk_rows)
    fitted = session.materialise(fitted, "arima-residuals")
    of = best.select(F.col(key).alias("_key"), "_n", "_mean", "_scale", "d", "p", "q", "const", "ar", "ma")
    fitted = fitted.join(of, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")

    def units(c):
        return F.col("_mean") + F.col("_scale") * c
    in_sample = fitted.select(key, "t", F.lit("fit").alias("kind"), units(F.col("y")).alias("y"),
                              units(F.col("y") - F.col("resid")).alias("fitted"), (F.col("_scale") * F.col("resid")).alias("resid"))

    # the recursion needs only the last max(p, d, q) + 1 rows of each key
    tail = fitted.where(F.col("t") >= F.col("_n") - (F.greatest("p", "d", "q") + 1))

    def forecast(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        p, d, q = int(pdf["p"].iloc[0]), int(pdf["d"].iloc[0]), int(pdf["q"].iloc[0])
        c = float(pdf["const"].iloc[0])
        ar = list(pdf["ar"].iloc[0]) if p else []
        ma = list(pdf["ma"].iloc[0]) if q else []
        y = list(pdf["y"].astype(float))
        w = list(pdf["w"].astype(float))
        eps = [0.0 if pd.isna(v) else float(v) for v in pdf["resid"]]
        last_t, mean, scale = int(pdf["t"].iloc[-1]), float(pdf["_mean"].iloc[0]), float(pdf["_scale"].iloc[0])
        out_t, out_y = [], []
        for h in range(1, horizon + 1):
            wn = c + sum(ar[i] * w[-1 - i] for i in range(p)) + sum(ma[j] * eps[-1 - j] for j in range(q))
            yn = wn - sum((-1) ** k * math.comb(d, k) * y[-k] for k in range(1, d + 1))
            w.append(wn)
            eps.append(0.0)
            y.append(yn)
            out_t.append(last_t + h)
            out_y.append(mean + scale * yn)
        return pd.DataFrame({key: pdf[key].iloc[0], "t": out_t, "kind": "forecast",
                             "y": None, "fitted": out_y, "resid": None})
    ahead = tail.groupBy(key).applyInPandas(
        forecast, f"{key} {key_type}, t long, kind string, y double, fitted double, resid double")
    return in_sample.unionByName(ahead)


# ---------------------------------------------------------------------------
# exact Gaussian likelihood
# ---------------------------------------------------------------------------

def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The solution of a x = b; NaN if there is none."""
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.full_like(b, np.nan)


class Models:
    """State-space form of the ARMA models of a key, as stacked arrays (companion form, r = max(P, Q + 1) states).  ``usable`` is
    False for models whose AR part is not stationary in double precision; white noise stands in their place."""

    def __init__(self, models: list[dict], r: int):
        n = len(models)
        self.n, self.r = n, r
        self.d = np.array([m["d"] for m in models])
        self.phi, self.load = np.zeros((n, r)), np.zeros((n, r))
        self.load[:, 0] = 1
        for i, m in enumerate(models):
            self.phi[i, :m["p"]] = m["ar"]
            self.load[i, 1:1 + m["q"]] = m["ma"]
        rest = np.array([1 - sum(m["ar"]) for m in models], dtype=float)
        const = np.array([m["const"] for m in models], dtype=float)
        self.usable = (rest > 0) & np.isfinite(const) & np.isfinite(self.phi).all(axis=1) & np.isfinite(self.load).all(axis=1)
        self._build()
        diagonal = np.diagonal(self.first, axis1=1, axis2=2)
        held = np.isfinite(self.first).all(axis=(1, 2)) & (diagonal >= 0).all(axis=1) & (diagonal.max(axis=1) <= STATE_MAX)
        if not (self.usable & held).all():
            self.usable &= held
            self._build()
        self.mean = np.where(self.usable, const, 0.0) / np.where(self.usable, rest, 1.0)

    def _build(self) -> None:
        n, r = self.n, self.r
        self.phi[~self.usable], self.load[~self.usable, 1:] = 0, 0
        self.shock = self.load[:, :, None] * self.load[:, None, :]
        self.move = np.zeros((n, r, r))
        self.move[:, :, 0] = self.phi
        self.move[:, np.arange(r - 1), np.arange(1, r)] = 1
        # stationary variance: vec(V) = (I - T x T)^-1 vec(RR')
        big = np.einsum("nij,nkl->nikjl", self.move, self.move).reshape(n, r * r, r * r)
        left, right = np.eye(r * r)[None] - big, self.shock.reshape(n, r * r, 1)
        try:
            self.first = np.linalg.solve(left, right).reshape(n, r, r)
        except np.linalg.LinAlgError:       # one of them has a root on the unit circle
            self.first = np.stack([_solved(a, b) for a, b in zip(left, right)]).reshape(n, r, r)

    def after(self, V: np.ndarray, of=slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(innovation variance, gain, next variance) of state variances V of the models ``of``."""
        f, phi = V[:, 0, 0], self.phi[of]
        tv = phi[:, :, None] * V[:, :1, :]              # move @ V
        tv[:, :-1] += V[:, 1:]
        gain = tv[:, :, 0] / f[:, None]
        nxt = tv[:, :, :1] * phi[:, None, :]            # tv @ move'
        nxt[:, :, :-1] += tv[:, :, 1:]
        nxt += self.shock[of] - gain[:, :, None] * gain[:, None, :] * f[:, None, None]
        return f, gain, nxt


class Variances:
    """The filter's variances and gains step by step; a model's first step is at index d, and where nothing changes any more all
    later steps are the same."""

    def __init__(self, models: Models, start: int):
        self.models, self.V, self.t, self.settled = models, models.first.copy(), 0, False
        self.moving, self.last = np.arange(models.n), (np.zeros(models.n), np.zeros((models.n, models.r)))
        while self.t < start and not self.settled:
            self.step()

    def step(self) -> tuple[np.ndarray, np.ndarray]:
        if self.settled:
            return self.last
        of = self.moving
        V = self.V[of]
        f, gain, nxt = self.models.after(V, of)
        live = self.models.d[of] <= self.t
        still = live & (np.abs(nxt - V).max(axis=(1, 2)) <= SETTLED * np.abs(V).max(axis=(1, 2)))
        self.V[of] = np.where(live[:, None, None], nxt, V)
        self.last[0][of], self.last[1][of] = f, gain
        self.t += 1
        if still.any():
            self.moving = of[~still]
            self.settled = not len(self.moving)
        return self.last


def chunk_maps(y: np.ndarray, t0: int, start: int, models: Models, block: int = 512):
    """What a chunk does to the state: (A, b) with state' = A state + b, and (H, logs): [state, 1] H [state, 1]'
    is its sum of squared innovations over their variances, logs the sum of log variances.  ``y`` begins at index ``t0``,
    the chunk's own rows at ``start``."""
    n, r = models.n, models.r
    w = differences(y, set(models.d.tolist()))
    W = np.stack([w[d] for d in models.d])[:, start - t0:] - models.mean[:, None]
    S = np.zeros((n, r, r + 1))
    S[:, np.arange(r), np.arange(r)] = 1
    H, logs = np.zeros((n, r + 1, r + 1)), np.zeros(n)
    var = Variances(models, start)
    phi = models.phi[:, :, None]
    for lo in range(0, W.shape[1], block):
        hi = min(lo + block, W.shape[1])
        V, inv = np.zeros((hi - lo, n, r + 1)), np.zeros((hi - lo, n))
        for i in range(lo, hi):
            f, gain = var.step()
            live = models.d <= start + i
            v = -S[:, 0, :]
            v[:, r] += W[:, i]
            nxt = phi * S[:, :1, :] + gain[:, :, None] * v[:, None, :]
            nxt[:, :-1] += S[:, 1:]
            if live.all():
                S = nxt
                inv[i - lo], V[i - lo] = 1 / f, v
                logs += np.log(f)
            else:
                S = np.where(live[:, None, None], nxt, S)
                inv[i - lo] = np.where(live, 1 / f, 0)
                V[i - lo] = v
                logs += np.where(live, np.log(f), 0)
        H += np.einsum("tna,tn,tnb->nab", V, inv, V)
    return S[:, :, :r], S[:, :, r], H, logs


def carry(maps: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(sum of squares, sum of logs) per model, of the chunks' maps in order, from a state of 0."""
    state = np.zeros_like(maps[0][1])
    squares = logs = 0.0
    for A, b, H, lg in maps:
        one = np.concatenate([state, np.ones((len(state), 1))], axis=1)
        squares = squares + np.einsum("na,nab,nb->n", one, H, one)
        logs = logs + lg
        state = np.einsum("nij,nj->ni", A, state) + b
    return squares, logs


def plain_sums(y: np.ndarray, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`carry` returns, of a key's whole series ``y`` in one walk."""
    n = models.n
    w = differences(y, set(models.d.tolist()))
    W = np.stack([w[d] for d in models.d], axis=1) - models.mean
    S, squares, logs, var = np.zeros((n, models.r)), np.zeros(n), np.zeros(n), Variances(models, 0)
    inv = log = None
    for t in range(len(W)):
        known = var.settled and inv is not None
        f, gain = var.step()
        if not known:
            inv, log = 1 / f, np.log(f)
        v = W[t] - S[:, 0]
        nxt = models.phi * S[:, :1] + gain * v[:, None]
        nxt[:, :-1] += S[:, 1:]
        if t >= models.d.max():
            S = nxt
            squares += v * v * inv
            logs += log
        else:
            live = models.d <= t
            S = np.where(live[:, None], nxt, S)
            squares += np.where(live, v * v * inv, 0)
            logs += np.where(live, log, 0)
    return squares, logs


def _of_sums(squares: np.ndarray, logs: np.ndarray, models: Models, n: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(log-likelihoods, variances) of a key's models."""
    obs = n - models.d
    sigma2 = squares / obs
    ll = -0.5 * (obs * (np.log(2 * np.pi * sigma2) + 1) + logs) - obs * math.log(scale)
    return np.where(models.usable, ll, np.nan), np.where(models.usable, sigma2 * scale ** 2, np.nan)


def _loglik(rows: DataFrame, own: DataFrame, key: str, r: int, max_d: int, chunk_rows: int) -> DataFrame:
    """``(key, _slice, i, loglik, sigma2)`` of the i-th of the ``models`` (array of d, p, q, const, ar, ma in standard units) of
    each key's slices."""
    key_type = rows.schema[key].dataType.simpleString()

    def maps(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return pa.table({key: left.column(key).slice(0, 0), "_slice": pa.array([], pa.int32()), "part": pa.array([], pa.int64()),
                             "maps": pa.array([], pa.list_(pa.float64()))})
        y, t0, start = _chunk(left)
        flat = [np.concatenate([x.ravel() for x in chunk_maps(y, t0, start, Models(models.as_py(), r))]) for models in right.column("models")]
        offsets = np.cumsum([0, *map(len, flat)]).astype(np.int32)
        return pa.table({key: right.column(key), "_slice": right.column("_slice"), "part": pa.array([start] * len(flat), pa.int64()),
                         "maps": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))})

    parts = in_chunks(rows, own, key, "t", "_n", F.lit(max_d), maps, f"`{key}` {key_type}, _slice int, part long, maps array<double>", chunk_rows)

    def combine(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right.slice(0, 1).to_pylist()[0]
        models, n = own["models"], len(own["models"])
        sizes = np.cumsum([n * r * r, n * r, n * (r + 1) * (r + 1)])
        order = np.argsort(left.column("part").to_numpy())
        pieces = []
        for i in order:
            a, b, h, lg = np.split(left.column("maps")[int(i)].values.to_numpy(), sizes)
            pieces.append((a.reshape(n, r, r), b.reshape(n, r), h.reshape(n, r + 1, r + 1), lg))
        ll, sigma2 = _of_sums(*carry(pieces), Models(models, r), own["_n"], own["_scale"])
        return pa.table({key: pa.array([own[key]] * n, right.schema.field(key).type), "_slice": pa.array([own["_slice"]] * n, pa.int32()),
                         "i": pa.array(np.arange(n, dtype=np.int32)), "loglik": pa.array(ll), "sigma2": pa.array(sigma2)})

    return (parts.groupBy(key, "_slice").cogroup(own.groupBy(key, "_slice"))
            .applyInArrow(combine, f"`{key}` {key_type}, _slice int, i int, loglik double, sigma2 double"))


def _accepted(fits: DataFrame, per_key: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """``per_key`` with ``models``: the successful fits of each key, or the ``top`` ones by AIC, in slices of ``SLICE`` (``_slice``)."""
    good = fits.where("status = 'ok'")
    if top is not None:
        rank = Window.partitionBy(key).orderBy("aic", "p", "d", "q")
        good = good.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= top)
    model = F.struct("d", "p", "q", F.col("_const").alias("const"), "ar", "ma")
    good = good.groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_list(model)).alias("_all"))       # at most the grid's size
    slices = F.explode(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / SLICE).cast("int"))).alias("_slice")
    good = good.select("_key", "_all", slices).select("_key", "_slice", F.slice("_all", F.col("_slice") * SLICE + 1, SLICE).alias("models"))
    return session.materialise(per_key.join(good, F.col(key).eqNullSafe(F.col("_key"))).drop("_key", "a"), "arima-models")


def _with_aic(out: DataFrame, key: str) -> DataFrame:
    coefs = F.col("p") + F.col("q") + (F.col("d") == 0).cast("int")
    w = Window.partitionBy(key).orderBy("aic", "p", "d", "q")
    return (out.withColumn("aic", -2 * F.col("loglik") + 2 * (coefs + 1)).withColumn("best", F.row_number().over(w) == 1))


def arima_likelihood(df: DataFrame, key: str = "currency", order: str = "current_time", value: str = "first_cost",
                     max_p: int = 4, max_d: int = 4, max_q: int = 4, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(key, p, d, q, loglik, sigma2, aic, best)`` of the successful fits: exact Gaussian log-likelihood of the n - d
    values of the differenced series, its variance estimate and AIC; ``best`` marks the least AIC of a key."""
    fits, rows, per_key = _fits(df, key, order, value, max_p, max_d, max_q, chunk_rows)
    own = _accepted(fits, per_key, key)
    ll = _loglik(rows, own, key, max(max_p, max_q + 1), max_d, chunk_rows).withColumnsRenamed({key: "_key", "_slice": "_of"})
    of = own.select(key, "_slice", F.posexplode("models").alias("_i", "_m"))
    out = of.join(ll, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")) & (F.col("i") == F.col("_i")))
    return _with_aic(out.select(key, "_m.p", "_m.d", "_m.q", "loglik", "sigma2"), key)


# ---------------------------------------------------------------------------
# maximum likelihood
# ---------------------------------------------------------------------------

def from_partial(u: np.ndarray) -> np.ndarray:
    """Coefficients of a stable recursion from unconstrained numbers: u / sqrt(1 + u^2) are its partial correlations."""
    out = np.zeros(0)
    u = np.clip(u, -1e8, 1e8)          # beyond, they are 1 or -1 as doubles
    for r in u / np.sqrt(1 + u * u):
        out = np.append(out - r * out[::-1], r)
    return out


def to_partial(c: np.ndarray) -> np.ndarray:
    """The inverse of :func:`from_partial`, for coefficients of a stable recursion."""
    c, out = np.array(c, dtype=float), []
    while len(c):
        r = c[-1]
        out.append(r)
        c = (c[:-1] + r * c[-2::-1]) / (1 - r * r) if len(c) > 1 else c[:0]
    r = np.clip(np.array(out[::-1]), -1 + 1e-9, 1 - 1e-9)
    return r / np.sqrt(1 - r * r)


STEPS = (16.0, 4.0, 2.0, 1.0, 0.5, 0.2, 0.05, 0.01, 0.001)      # of a search along a direction
FULL = STEPS.index(1.0)
SHIFT = 1e-4            # of a difference, for parameters up to 1; larger ones in proportion
CURVED = 1e-6           # least curvature, of the largest one
LEAST_GAIN = 1e-4       # of a log-likelihood: a search whose next step gains no more has settled


def _around(at: np.ndarray) -> np.ndarray:
    """The points beside ``at`` that give the gradient and the curvatures: up, down, and up in two parameters."""
    k = len(at)
    e = np.diag(SHIFT * np.maximum(1.0, np.abs(at)))
    i, j = np.triu_indices(k, 1)
    return np.vstack([at + e, at - e, at + e[i] + e[j]])


class Climb:
    """Newton ascent of one model's log-likelihood, told of the function's values from outside: ``points`` are wanted, ``tell``
    takes their values, until ``settled``.  A search along a line also asks for the points beside its full step, so a full step
    needs no pass of its own for the next direction."""

    def __init__(self, theta, value=None, direction=None, settled=False):
        self.theta, self.value, self.settled = np.asarray(theta, dtype=float), value, settled
        self.direction = None if direction is None else np.asarray(direction, dtype=float)

    def points(self) -> np.ndarray:
        if self.settled or not len(self.theta):        # without coefficients there is nothing to search
            return self.theta[None, :]
        if self.direction is None:
            return np.vstack([self.theta, _around(self.theta)])
        return np.vstack([[self.theta + a * self.direction for a in STEPS], _around(self.theta + self.direction)])

    def tell(self, values: np.ndarray) -> None:
        values = np.where(np.isfinite(values), values, -np.inf)
        if self.settled:
            return
        if not len(self.theta):
            self.value, self.settled = float(values[0]), True
        elif self.direction is None:
            self.value = float(values[0])
            if np.isfinite(self.value):
                self._turn(values[1:])
            elif not self.theta.any():
                self.settled = True                     # not even white noise has a value
            else:                                       # not stationary in double precision: inwards
                self.theta = np.where(np.abs(self.theta) > 1e-3, self.theta / 2, 0.0)
        else:
            self._step(values[:len(STEPS)], values[len(STEPS):])

    def _step(self, along: np.ndarray, around: np.ndarray) -> None:
        best = int(along.argmax())
        gain = along[best] - self.value
        if along[FULL] - self.value >= 0.75 * gain:
            best = FULL
        if gain > 0:
            self.theta, self.value = self.theta + STEPS[best] * self.direction, float(along[best])
        self.direction = None
        if not gain > LEAST_GAIN:
            self.settled = True
        elif best == FULL:
            self._turn(around)

    def _turn(self, around: np.ndarray) -> None:
        """The direction from ``theta``, by the values around it."""
        k, middle = len(self.theta), self.value
        i, j = np.triu_indices(k, 1)
        up, down, both = around[:k], around[k:2 * k], around[2 * k:]
        # a side without a value (a model that is not stationary) gives way to the middle
        sides = np.isfinite(up).astype(int) + np.isfinite(down)
        high, low = np.where(np.isfinite(up), up, middle), np.where(np.isfinite(down), down, middle)
        gradient = (high - low) / np.maximum(sides, 1) / SHIFT
        bend = np.zeros((k, k))                         # of the negative function
        bend[i, j] = bend[j, i] = np.where(np.isfinite(up[i]) & np.isfinite(up[j]) & np.isfinite(both), high[i] + high[j] - np.where(np.isfinite(both), both, 0.0) - middle, 0.0) / SHIFT ** 2
        np.fill_diagonal(bend, np.where(sides == 2, (2 * middle - high - low) / SHIFT ** 2, 100.0))
        size, axes = np.linalg.eigh(bend)
        size = np.maximum(np.abs(size), max(CURVED * np.abs(size).max(), 1e-300))
        step = axes @ ((axes.T @ gradient) / size)
        if np.isfinite(step).all() and gradient @ step > 2 * LEAST_GAIN:
            self.direction = step * np.maximum(1.0, np.abs(self.theta))
        else:
            self.settled = True


def _model(m: dict, theta: np.ndarray) -> dict:
    """The model of parameters (mean if d = 0, then both partial correlations' numbers)."""
    off = int(m["d"] == 0)
    ar, ma = from_partial(theta[off:off + m["p"]]), -from_partial(theta[off + m["p"]:])
    return {"d": m["d"], "p": m["p"], "q": m["q"], "const": float(theta[0] * (1 - ar.sum())) if off else 0.0, "ar": ar.tolist(), "ma": ma.tolist()}


def _start(m: dict) -> np.ndarray:
    mean = [m["const"] / (1 - sum(m["ar"]))] if m["d"] == 0 else []
    return np.concatenate([mean, to_partial(m["ar"]), to_partial(-np.array(m["ma"], dtype=float))])


MODEL_TYPE = "struct<d:int,p:int,q:int,const:double,ar:array<double>,ma:array<double>>"

# a pass has few bytes and much arithmetic: its keys go to all cores
SMALL_PARTS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}


def arima_mle(df: DataFrame, key: str = "currency", order: str = "current_time", value: str = "first_cost", max_p: int = 4,
              max_d: int = 4, max_q: int = 4, top: int | None = None, rounds: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(key, p, d, q, loglik, sigma2, const, ar, ma, aic, best)``: every successful fit of each key (or the ``top`` ones by AIC),
    taken from its regression estimates to a maximum of the exact likelihood.

    A Newton search over partial correlations, so every point is stationary and invertible.  One pass over the rows
    evaluates the wanted points of all keys and models together (:func:`chunk_maps`); the searches themselves are a few numbers per
    model, carried in a table between passes.  Passes go on until every search has settled, or for ``rounds`` of two passes.
    Those of a key of one chunk of rows all run in the task that has the chunk."""
    fits, rows, per_key = _fits(df, key, order, value, max_p, max_d, max_q, chunk_rows)
    own = _accepted(fits, per_key, key, top)
    r = max(max_p, max_q + 1)
    carried = [key, "_slice", "_n", "_m", "_mean", "_scale"]
    types = dict(own.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in carried) + ", models array<" + MODEL_TYPE + ">"
    searched = schema + ", climbs array<struct<base:" + MODEL_TYPE + ",theta:array<double>,value:double,direction:array<double>,settled:boolean>>"

    def row_of(first, bases: list[dict], climbs: list[Climb]) -> pd.DataFrame:
        packed = [{"base": b, "theta": c.theta.tolist(), "value": c.value, "direction": None if c.direction is None else c.direction.tolist(),
                   "settled": c.settled} for b, c in zip(bases, climbs)]
        wanted = [_model(m, p) for m, c in zip(bases, climbs) if not c.settled for p in c.points()]
        return pd.DataFrame([{**{c: first[c] for c in carried}, "models": wanted, "climbs": packed}])

    def plain(m) -> dict:
        return {**{k: int(m[k]) for k in ("d", "p", "q")}, "const": float(m["const"]), "ar": [float(x) for x in m["ar"]], "ma": [float(x) for x in m["ma"]]}

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        bases = [plain(m) for m in first["models"]]
        return row_of(first, bases, [Climb(_start(m)) for m in bases])

    def unpacked(first) -> tuple[list[dict], list[Climb]]:
        return ([plain(c["base"]) for c in first["climbs"]],
                [Climb(c["theta"], c["value"], c["direction"], bool(c["settled"])) for c in first["climbs"]])

    def told(climbs: list[Climb], values: np.ndarray) -> None:
        at = 0
        for c in climbs:
            if not c.settled:
                n = len(c.points())
                c.tell(values[at:at + n])
                at += n

    def advance(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        first = right.iloc[0]
        bases, climbs = unpacked(first)
        told(climbs, left.sort_values("i")["loglik"].to_numpy())
        return row_of(first, bases, climbs)

    def climb(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """All passes of a key's slices over its one chunk."""
        y, out = left.sort_values("t")["y"].to_numpy(dtype=float), []
        for _, first in right.iterrows():
            bases, climbs = unpacked(first)
            for _ in count() if rounds is None else range(2 * rounds):
                wanted = [_model(m, p) for m, c in zip(bases, climbs) if not c.settled for p in c.points()]
                if not wanted:
                    break
                models = Models(wanted, r)
                told(climbs, _of_sums(*plain_sums(y, models), models, int(first["_n"]), float(first["_scale"]))[0])
            out.append(row_of(first, bases, climbs))
        return pd.concat(out) if out else right

    def end(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        return pd.DataFrame([{**{c: first[c] for c in carried}, "models": [_model(plain(c["base"]), np.asarray(c["theta"], dtype=float)) for c in first["climbs"]]}])

    state = session.materialise(own.groupBy(key, "_slice").applyInPandas(begin, searched), "arima-search")
    with session.settings(df.sparkSession, SMALL_PARTS):
        whole = F.col("_n") <= chunk_rows
        short = session.materialise(rows.where(whole).groupBy(key).cogroup(state.where(whole).groupBy(key)).applyInPandas(climb, searched), "arima-searched")
        state = state.where(~whole)
        for _ in count() if rounds is None else range(2 * rounds):
            left = state.where(F.size("models") > 0)
            if left.isEmpty():
                break
            ll = _loglik(rows, left.drop("climbs"), key, r, max_d, chunk_rows)
            state = session.materialise(ll.groupBy(key, "_slice").cogroup(state.groupBy(key, "_slice")).applyInPandas(advance, searched), "arima-search")
    state = session.materialise(short.unionAll(state).groupBy(key, "_slice").applyInPandas(end, schema), "arima-fitted")
    ll = _loglik(rows, state, key, r, max_d, chunk_rows).withColumnsRenamed({key: "_key", "_slice": "_of"})
    of = state.select(key, "_slice", "_mean", "_scale", F.posexplode("models").alias("_at", "_fit"))
    out = of.join(ll, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")) & (F.col("i") == F.col("_at")))
    rest = 1 - F.aggregate("_fit.ar", F.lit(0.0), lambda a, x: a + x)
    const = F.when(F.col("_fit.d") == 0, F.col("_mean") * rest + F.col("_scale") * F.col("_fit.const")).otherwise(F.lit(0.0))
    return _with_aic(out.select(key, "_fit.p", "_fit.d", "_fit.q", "loglik", "sigma2", const.alias("const"), "_fit.ar", "_fit.ma"), key)
