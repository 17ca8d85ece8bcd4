"""Series operators against brute-force numpy/pandas computations on the
fact rows of the sf0.01 test tables (collected: a few hundred rows)."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

from feed_help import SF01
from marketlens.operators import series as X
from marketlens.operators.analysis import CoMoments, corr_matrix
from marketlens.operators.arima import arima_fits
from marketlens.plans.tv import saved_trade_volume


@pytest.fixture(scope="module")
def tv(spark):
    return saved_trade_volume(spark, SF01).cache()


@pytest.fixture(scope="module")
def series_np(tv):
    pdf = tv.select("currency", "current_time", "first_cost", "buy_avg_quantity").toPandas()
    return {k: g.sort_values("current_time") for k, g in pdf.groupby("currency")}


def test_acf_pacf(tv, series_np):
    a = X.acf(tv, nlags=6).toPandas()
    p = X.pacf(X.acf(tv, nlags=6)).toPandas()
    for cur, g in series_np.items():
        y = g["first_cost"].to_numpy()
        d = y - y.mean()
        want = [np.sum(d[k:] * d[:len(d) - k]) / np.sum(d * d) for k in range(7)]
        got = a[a.currency == cur].sort_values("lag")["acf"].to_numpy()
        assert np.allclose(got, want, atol=1e-10)
        for k in range(1, 7):   # Yule-Walker: last coefficient of the order-k fit
            toe = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
            phi = np.linalg.solve(toe, np.array(want[1:k + 1]))
            got_k = p[(p.currency == cur) & (p.lag == k)]["pacf"].iloc[0]
            assert abs(got_k - phi[-1]) < 1e-8


def _adf_ref(x):
    n = len(x)
    maxlag = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

    def fit(lag, start):
        X_ = np.array([[1.0, x[t - 1]] + [x[t - i] - x[t - i - 1] for i in range(1, lag + 1)]
                       for t in range(start, n)])
        y_ = np.array([x[t] - x[t - 1] for t in range(start, n)])
        b, *_ = np.linalg.lstsq(X_, y_, rcond=None)
        ssr = float(np.sum((y_ - X_ @ b) ** 2))
        nobs, k = len(y_), X_.shape[1]
        aic = nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * k
        se = math.sqrt(ssr / (nobs - k) * np.linalg.inv(X_.T @ X_)[1, 1])
        return aic, b[1] / se, nobs
    best = min((fit(lag, maxlag + 1)[0], lag) for lag in range(maxlag + 1))
    _, stat, nobs = fit(best[1], best[1] + 1)
    return stat, best[1], nobs, best[0]


def test_adf_autolag_matches_brute_force(tv, series_np):
    got = X.adf(tv).toPandas().set_index("currency")
    for cur, g in series_np.items():
        stat, lag, nobs, ic = _adf_ref(g["first_cost"].to_numpy())
        r = got.loc[cur]
        assert r.usedlag == lag and r.nobs == nobs
        assert abs(r.adf_stat - stat) < 1e-7 and abs(r.icbest - ic) < 1e-6
        assert r.crit_1pct < r.crit_5pct < r.crit_10pct < 0
        assert 0.0 <= r.pvalue <= 1.0


def test_adf_pvalue_monotone():
    ps = [X.adf_pvalue(s) for s in (-6.0, -4.0, -3.0, -2.0, -1.0, 0.0, 1.0)]
    assert ps == sorted(ps) and ps[0] < 0.01 and ps[-1] > 0.9


def test_ar_linear_matches_lstsq(tv, series_np):
    got = X.ar_linear(tv, ["first_cost"], 3).toPandas()
    for cur, g in series_np.items():
        y = g["first_cost"].to_numpy()
        X_ = np.array([[1.0] + [y[t - k] for k in range(1, 4)] for t in range(3, len(y))])
        b, *_ = np.linalg.lstsq(X_, y[3:], rcond=None)
        coef = got[got.currency == cur].sort_values("term")["coef"].to_numpy()
        assert np.allclose(coef, b, atol=1e-6)


def test_arima_hannan_rissanen_matches_numpy(tv, series_np):
    fits = arima_fits(tv, max_p=2, max_d=1, max_q=2)
    pdf = fits.toPandas()
    P, Q = 2, 2
    fitted = 0
    for cur, g in list(series_np.items())[:3]:
        y = g["first_cost"].to_numpy()
        n = len(y)
        m = max(int(math.floor(math.log(n) ** 2)), 2 * max(P, Q))
        for d in (0, 1):
            w = {t: (y[t] if d == 0 else y[t] - y[t - 1]) for t in range(d, n)}
            rows = range(d + m, n)
            A = np.array([[1.0] + [w[t - i] for i in range(1, m + 1)] for t in rows])
            a, *_ = np.linalg.lstsq(A, np.array([w[t] for t in rows]), rcond=None)
            e = {t: w[t] - A[i] @ a for i, t in enumerate(rows)}
            rows2 = range(1 + m + Q, n)      # common to d = 0 and 1
            for p in range(P + 1):
                for q in range(Q + 1):
                    cols = [[1.0] if d == 0 else [] for _ in rows2]
                    Xm = np.array([c + [w[t - i] for i in range(1, p + 1)] + [e[t - j] for j in range(1, q + 1)]
                                   for c, t in zip(cols, rows2)]).reshape(len(rows2), -1)
                    yv = np.array([w[t] for t in rows2])
                    b = np.linalg.lstsq(Xm, yv, rcond=None)[0] if Xm.shape[1] else np.zeros(0)
                    ssr = float(np.sum((yv - (Xm @ b if Xm.shape[1] else 0)) ** 2))
                    nobs = len(yv)
                    aic = nobs * (math.log(2 * math.pi * ssr / nobs) + 1) + 2 * (Xm.shape[1] + 1)
                    r = pdf[(pdf.currency == cur) & (pdf.p == p) & (pdf.d == d) & (pdf.q == q)].iloc[0]
                    k = Xm.shape[1]
                    if nobs < 3 * (k + 1):
                        assert r.status == "too few observations" and math.isnan(r.aic)
                        continue
                    ar, ma = b[k - p - q:k - q], b[k - q:]
                    roots = lambda c: np.roots([*c[::-1], 1.0])
                    want = ("not stationary" if p and np.any(np.abs(roots(-ar)) <= 1 + 1e-6)
                            else "not invertible" if q and np.any(np.abs(roots(ma)) <= 1 + 1e-6) else "ok")
                    assert r.status == want and abs(r.aic - aic) < 1e-6 * max(1, abs(aic))
                    fitted += want == "ok"
    best = pdf[pdf.best]
    assert fitted > 3 and best.groupby("currency").size().eq(1).all() and (best.status == "ok").all()


def test_qq_points(tv, series_np):
    got = X.qq_points(tv).toPandas()
    for cur, g in list(series_np.items())[:3]:
        y = np.sort(g["first_cost"].to_numpy())
        n = len(y)
        z = np.array([NormalDist().inv_cdf(i / (n + 1)) for i in range(1, n + 1)])
        r = got[got.currency == cur].sort_values("i")
        assert np.allclose(r["z"], z, atol=1e-12) and np.allclose(r["sample"], y)
        assert np.allclose(r["fit"], z * y.std() + y.mean(), atol=1e-9)


def test_corr_matrix_pairwise_deletion(spark):
    rnd = np.random.default_rng(3)
    pdf = pd.DataFrame(rnd.normal(size=(60, 3)), columns=["a", "b", "c"])
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    pdf["currency"] = ["X", "Y"] * 30
    sdf = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                "a double, b double, c double, currency string")
    got = corr_matrix(sdf, ["a", "b", "c"]).toPandas()
    for cur, g in pdf.groupby("currency"):
        want = g[["a", "b", "c"]].corr()
        for _, r in got[got.currency == cur].iterrows():
            assert abs(r.r - want.loc[r.col_x, r.col_y]) < 1e-10


def test_corr_matrix_is_one_scan_and_keeps_the_null_key(spark):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=4000)
    rows = [(None if i % 5 == 0 else "K", float(1e9 + v), float(1e9 - v), 7.5) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "currency string, a double, b double, c double").repartition(7)
    m = corr_matrix(df, ["a", "b", "c"])
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    got = {(r.currency, r.col_x, r.col_y): r.r for r in m.collect()}
    assert len(got) == 12
    for k in ("K", None):
        a = np.array([r[1] for r in rows if r[0] == k])
        b = np.array([r[2] for r in rows if r[0] == k])
        assert got[k, "a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)
        assert math.isnan(got[k, "a", "c"]) and math.isnan(got[k, "c", "c"])


def test_comoments_merge_in_any_grouping():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(300, 3)) * [1, 1e-6, 100] + [1e6, 1, -5]
    x[rnd.random(x.shape) < 0.2] = np.nan
    parts = [CoMoments.of(x[a:b]) for a, b in zip([0, 1, 2, 50, 51, 200], [1, 2, 50, 51, 200, 300])]
    while len(parts) > 1:
        i = len(parts) // 2 - 1
        parts[i:i + 2] = [parts[i].merge(parts[i + 1])]
    r, _ = parts[0].correlations()
    assert np.allclose(r, pd.DataFrame(x).corr().to_numpy(), atol=1e-10)


def walk(level, n=300, seed=4):
    r = np.random.default_rng(seed)
    e = r.normal(size=n)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = 0.9 * x[t - 1] + e[t] + 0.3 * e[t - 1]
    return level * (1 + 0.002 * x)


@pytest.mark.parametrize("level", [60_000.0, 50.0, 2e-6])
def test_regressions_at_any_price_level(spark, level):
    y = walk(level)
    df = spark.createDataFrame([("K", int(t), float(v)) for t, v in enumerate(y)], "currency string, current_time long, first_cost double")
    got = X.adf(df).first()
    stat, lag, nobs, ic = _adf_ref(y / level)       # the statistic has no unit
    assert got.error is None and got.usedlag == lag and got.nobs == nobs
    assert got.adf_stat == pytest.approx(stat, abs=1e-6)
    assert got.icbest == pytest.approx(ic + 2 * (len(y) - math.ceil(12 * (len(y) / 100) ** 0.25) - 1) * math.log(level), rel=1e-6)
    coef = X.ar_linear(df, ["first_cost"], 3).orderBy("term").toPandas()
    A = np.array([[1.0] + [y[t - k] / level for k in range(1, 4)] for t in range(3, len(y))])
    b, *_ = np.linalg.lstsq(A, y[3:] / level, rcond=None)
    b[0] *= level
    assert np.allclose(coef["coef"], b, rtol=1e-6, atol=1e-6 * min(1, level))
    fits = arima_fits(df, max_p=2, max_d=1, max_q=1)
    pdf = fits.toPandas()
    assert not pdf.status.str.contains("singular|degenerate").any()
    assert pdf[pdf.best].d.iloc[0] == 0


def test_nan_is_no_observation(spark):
    y = walk(50.0)
    rows = [("K", t, float(v)) for t, v in enumerate(y)]
    clean = spark.createDataFrame(rows, "currency string, current_time long, first_cost double")
    dirty = spark.createDataFrame(rows + [("K", 10_000 + i, float("nan")) for i in range(7)] + [("K", 20_000, None)], clean.schema)
    assert X.adf(dirty).first() == X.adf(clean).first()
    assert X.acf(dirty, nlags=3).orderBy("lag").collect() == X.acf(clean, nlags=3).orderBy("lag").collect()


def test_forecasts_grow_at_most_as_polynomials(spark, tv):
    from marketlens.operators.arima import arima_forecast, outside_unit_circle
    pdf = arima_forecast(tv, horizon=400).toPandas()
    ahead = pdf[pdf.kind == "forecast"]
    fits = arima_fits(tv)
    best = fits.where("best").toPandas().set_index("currency")
    for cur, g in ahead.groupby("currency"):
        f = g.sort_values("t")["fitted"].to_numpy()
        d = int(best.loc[cur].d)
        assert outside_unit_circle(list(best.loc[cur].ar), -1) and outside_unit_circle(list(best.loc[cur].ma), 1)
        rest = np.diff(f, d)                        # the d-th differences settle
        assert np.all(np.isfinite(f)) and np.abs(rest[200:]).max() <= np.abs(rest[:200]).max() + 1e-6
    assert not outside_unit_circle([1.2], -1) and outside_unit_circle([0.5], -1) and outside_unit_circle([], 1)
    assert not outside_unit_circle([2.0], 1) and outside_unit_circle([0.0, 0.4], 1)


def test_correlogram_bands(tv, series_np):
    got = X.correlogram(tv, nlags=4).toPandas()
    for cur, g in list(series_np.items())[:4]:
        y = g["first_cost"].to_numpy()
        d, n = y - y.mean(), len(y)
        r = [np.sum(d[k:] * d[:n - k]) / np.sum(d * d) for k in range(5)]
        rows = got[got.currency == cur].sort_values("lag")
        want = [0.0] + [1.959963984540054 * math.sqrt((1 + 2 * sum(x * x for x in r[1:k])) / n) for k in range(1, 5)]
        assert np.allclose(rows["acf"], r) and np.allclose(rows["acf_band"], want)
        assert np.allclose(rows["pacf_band"][1:], 1.959963984540054 / math.sqrt(n))


def test_residual_diagnostics_use_the_models_residuals(spark):
    from marketlens.operators.arima import arima_forecast
    df = spark.createDataFrame([("K", t, float(v)) for t, v in enumerate(walk(50.0, 400))], "currency string, current_time long, first_cost double")
    fit = arima_forecast(df, horizon=1, max_p=2, max_d=1, max_q=1).where("kind = 'fit'")
    e = fit.where("resid IS NOT NULL").orderBy("t").toPandas()["resid"].to_numpy()
    d = e - e.mean()
    got = X.correlogram(fit, order="t", value="resid", nlags=3).orderBy("lag").toPandas()
    assert np.allclose(got["acf"], [np.sum(d[k:] * d[:len(d) - k]) / np.sum(d * d) for k in range(4)])
    assert (np.abs(got["acf"][1:]) < 3 * got["acf_band"][1:]).all()        # close to white noise
    assert X.adf(fit, order="t", value="resid", maxlag=1, autolag=None).first().adf_stat < -8
