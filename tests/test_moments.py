"""Lag moments, chunked residuals and the exact likelihood against plain sequential computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.operators import arima as A
from marketlens.operators import series as X
from marketlens.operators.moments import Moments, Run, differences

PAIRS = ((0, 0), (0, 1), (1, 1), (2, 2))
SCHEMA = "currency string, current_time long, first_cost double"


def walk(n, seed, level=50.0, ar=0.9, ma=0.3):
    r = np.random.default_rng(seed)
    e, x = r.normal(size=n), np.zeros(n)
    for t in range(1, n):
        x[t] = ar * x[t - 1] + e[t] + ma * e[t - 1]
    return level * (1 + 0.002 * x)


def frame(spark, named):
    return spark.createDataFrame([(k, int(t), float(v)) for k, y in named.items() for t, v in enumerate(y)], SCHEMA)


def merged(y, cuts, lags):
    runs = [Run.of(a, y[a:b], PAIRS, lags) for a, b in zip(cuts, cuts[1:])]
    while len(runs) > 1:                # in any grouping
        i = (len(runs) * 7 + 3) % (len(runs) - 1)
        runs[i:i + 2] = [runs[i].merge(runs[i + 1], PAIRS, lags)]
    return Moments(runs[0], PAIRS, lags)


@pytest.mark.parametrize("cuts", [[0, 200], [0, 1, 2, 5, 9, 50, 53, 120, 199, 200], list(range(0, 201, 3)) + [200], list(range(201))])
def test_grams_from_merged_runs(cuts):
    y = np.cumsum(np.random.default_rng(0).normal(size=200))
    n, m = 200, merged(y, sorted(set(cuts)), 6)

    def lag(x, k):
        return np.concatenate([np.zeros(k), x[:n - k]])

    for d in (0, 1, 2):
        w = differences(y, [d])[d]
        for order in (0, 1, 4, 6):
            for s in (d + order, d + order + 2):
                if s + 2 > 6 + 2 + 2:
                    continue
                x = np.array([np.ones(n), *[lag(w, k) for k in range(1, order + 1)], w]).T[s:]
                assert np.allclose(m.lag_gram(d, order, s), x.T @ x, rtol=1e-11, atol=1e-9)
    dy = differences(y, [1])[1]
    for order in (0, 1, 5):
        x = np.array([np.ones(n), lag(y, 1), *[lag(dy, k) for k in range(1, order + 1)], dy]).T[order + 1:]
        assert np.allclose(m.unit_root_gram(order, order + 1), x.T @ x, rtol=1e-11, atol=1e-9)


def test_small_steps_around_a_high_level_keep_their_digits():
    y = 1e3 + 1e-4 * np.cumsum(np.random.default_rng(1).normal(size=5000))
    m = Moments(Run.of(0, y, PAIRS, 6), PAIRS, 6)
    dy = np.diff(y)
    assert m.unit_root_gram(0, 1)[2, 2] == pytest.approx(dy @ dy, rel=1e-12)


def plan_size(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("#"), plan.count("lag")


def test_adf_plan_does_not_widen_with_the_series(spark):
    small = frame(spark, {"K": walk(60, 1)})
    large = frame(spark, {"K": walk(6000, 1)})
    assert plan_size(X.adf(small)) == plan_size(X.adf(large))
    assert X.adf(large).first().usedlag <= X.default_maxlag(6000) == 34


def test_adf_ignores_how_rows_are_cut(spark):
    df = frame(spark, {"A": walk(700, 2), "B": walk(350, 3), None: walk(90, 4)})
    one = {r.currency: r for r in X.adf(df.coalesce(1)).collect()}
    with_small_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = {r.currency: r for r in X.adf(df.repartition(9)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_small_batches)
    assert one.keys() == many.keys() == {"A", "B", None}
    for k in one:
        assert many[k].adf_stat == pytest.approx(one[k].adf_stat, rel=1e-9) and many[k].usedlag == one[k].usedlag


def test_arima_ignores_chunks(spark):
    df = frame(spark, {"A": walk(500, 5), None: walk(260, 6)})
    get = lambda c: {(r.currency, r.p, r.d, r.q): r for r in A.arima_fits(df, max_p=2, max_d=1, max_q=2, chunk_rows=c).collect()}
    whole, cut = get(10_000), get(60)
    assert whole.keys() == cut.keys() and len(whole) == 36
    for k, r in whole.items():
        assert cut[k].status == r.status and cut[k].best == r.best
        if r.aic is not None:
            assert cut[k].aic == pytest.approx(r.aic, rel=1e-9) and cut[k].ar == pytest.approx(r.ar, rel=1e-6, abs=1e-9)
    plans = [A.arima_fits(df, max_p=2, max_d=1, max_q=2)]
    assert all("w_lag" not in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)
    fore = lambda c: A.arima_forecast(df, horizon=5, max_p=2, max_d=1, max_q=2, chunk_rows=c).toPandas().sort_values(["currency", "kind", "t"], na_position="last")
    a, b = fore(10_000), fore(60)
    assert len(a) == len(b) == 500 + 260 + 10
    assert np.allclose(a["fitted"], b["fitted"], rtol=1e-9, equal_nan=True)


def kalman(w, phi, theta, mean):
    """Sequential exact likelihood: (sum of squares, sum of log variances)."""
    r = max(len(phi), len(theta) + 1)
    T, R = np.zeros((r, r)), np.zeros(r)
    T[:len(phi), 0] = phi
    T[np.arange(r - 1), np.arange(1, r)] = 1
    R[0], R[1:1 + len(theta)] = 1, theta
    V = np.linalg.solve(np.eye(r * r) - np.kron(T, T), np.outer(R, R).ravel()).reshape(r, r)
    a, squares, logs = np.zeros(r), 0.0, 0.0
    for x in w - mean:
        v, f = x - a[0], V[0, 0]
        gain = T @ V[:, 0] / f
        squares += v * v / f
        logs += math.log(f)
        a = T @ a + gain * v
        V = T @ V @ T.T + np.outer(R, R) - np.outer(gain, gain) * f
    return squares, logs


@pytest.mark.parametrize("chunk", [50, 10_000])
def test_exact_likelihood_equals_the_sequential_filter(spark, chunk):
    named = {"A": walk(420, 7), "B": walk(300, 8, 2e-6, 0.5, -0.6), "C": np.cumsum(walk(200, 9, 3.0))}
    df = frame(spark, named)
    fits = {(r.currency, r.p, r.d, r.q): r for r in A.arima_fits(df, max_p=2, max_d=2, max_q=2).where("status = 'ok'").collect()}
    got = A.arima_likelihood(df, max_p=2, max_d=2, max_q=2, chunk_rows=chunk).collect()
    assert {(r.currency, r.p, r.d, r.q) for r in got} == set(fits) and len(got) > 30
    for g in got:
        f = fits[g.currency, g.p, g.d, g.q]
        y = named[g.currency]
        w = np.diff(y, g.d)
        mean = f.const / (1 - sum(f.ar)) if g.d == 0 else 0.0
        squares, logs = kalman(w, np.array(f.ar), np.array(f.ma), mean)
        n = len(w)
        ll = -0.5 * (n * (math.log(2 * math.pi * squares / n) + 1) + logs)
        assert g.loglik == pytest.approx(ll, rel=1e-8, abs=1e-8)
        assert g.aic == pytest.approx(-2 * ll + 2 * (g.p + g.q + (g.d == 0) + 1), rel=1e-8)
    for k in named:
        mine = [g for g in got if g.currency == k]
        assert [g.best for g in mine].count(True) == 1
        assert min(mine, key=lambda g: (g.aic, g.p, g.d, g.q)).best


def test_likelihood_settles_and_prefers_the_true_model():
    r = np.random.default_rng(3)
    e, x = r.normal(size=3000), np.zeros(3000)
    for t in range(1, 3000):
        x[t] = 0.7 * x[t - 1] + e[t]
    models = A.Models([{"d": 0, "p": 1, "q": 0, "const": 0.0, "ar": [f], "ma": []} for f in (0.2, 0.7, 0.95)], 3)
    v = A.Variances(models, 500)
    assert v.settled and v.t < 100
    squares, logs = A.carry([A.chunk_maps(x, 0, 0, models)])
    ll = -0.5 * (3000 * np.log(squares / 3000) + logs)
    assert ll.argmax() == 1
    part = [A.chunk_maps(x[max(0, a - 1):a + 500], max(0, a - 1), a, models) for a in range(0, 3000, 500)]
    assert np.allclose(A.carry(part)[0], squares, rtol=1e-12)


def exact_ll(y, d, mean, ar, ma):
    w = np.diff(y, d)
    squares, logs = kalman(w, np.array(ar), np.array(ma), mean)
    n = len(w)
    return -0.5 * (n * (math.log(2 * math.pi * squares / n) + 1) + logs)


def test_partial_correlations_round_trip():
    r = np.random.default_rng(2)
    for _ in range(50):
        u = r.normal(size=r.integers(0, 5))
        c = A.from_partial(u)
        assert A.outside_unit_circle(list(c), -1)
        assert np.allclose(A.to_partial(c), u, atol=1e-7)


def test_climb_finds_the_top():
    target = np.array([0.4, -1.0, 2.0])
    scale = np.array([[900.0, 40, 0], [40, 5, 1], [0, 1, 60]])
    f = lambda x: -float((x - target) @ scale @ (x - target))
    c = A.Climb(np.zeros(3))
    for _ in range(30):
        c.tell(np.array([f(p) for p in c.points()]))
    assert np.allclose(c.theta, target, atol=1e-3)


@pytest.mark.parametrize("chunk", [70, 10_000])
def test_maximum_likelihood(spark, chunk):
    named = {"A": walk(400, 21, 50.0, 0.6, 0.4), "B": walk(250, 22, 2e-6, 0.5, -0.5)}
    df = frame(spark, named)
    before = {(r.currency, r.p, r.d, r.q): r.loglik for r in A.arima_likelihood(df, max_p=1, max_d=1, max_q=1).collect()}
    got = A.arima_mle(df, max_p=1, max_d=1, max_q=1, top=2, rounds=5, chunk_rows=chunk).collect()
    assert len(got) == 4 and sum(g.best for g in got) == 2
    for g in got:
        y = named[g.currency]
        mean = g.const / (1 - sum(g.ar)) if g.d == 0 else 0.0
        top = exact_ll(y, g.d, mean, g.ar, g.ma)
        assert g.loglik == pytest.approx(top, rel=1e-8, abs=1e-6)
        assert g.loglik >= before[g.currency, g.p, g.d, g.q] - 1e-9
        spread = float(np.std(y))
        for shift in (-0.02, 0.02):                     # no better point nearby
            near = [exact_ll(y, g.d, mean, [a + shift for a in g.ar], g.ma)] if g.ar else []
            near += [exact_ll(y, g.d, mean, g.ar, [m + shift for m in g.ma])] if g.ma else []
            near += [exact_ll(y, 0, mean + shift * spread * 5, g.ar, g.ma)] if g.d == 0 else []
            assert all(top >= v - 1e-3 for v in near)


def test_models_on_the_unit_circle_have_no_likelihood():
    """A search may ask for points whose AR part is not stationary in double precision; they do not end the job."""
    edge = [A.from_partial(np.array(u)) for u in ([1e9], [5.0, 1e9], [3e4] * 4, [1e200])]
    models = [{"d": 0, "p": len(a), "q": 0, "const": 1.0, "ar": a.tolist(), "ma": []} for a in edge]
    inside = {"d": 0, "p": 1, "q": 1, "const": 1.0, "ar": [0.5], "ma": [0.3]}
    got = A.Models([*models, inside], 5)
    alone = A.Models([inside], 5)
    assert got.usable.tolist() == [False] * 4 + [True]
    assert np.array_equal(got.first[-1], alone.first[0]) and got.mean[-1] == alone.mean[0] == 2.0
    assert np.isfinite(got.first).all() and np.isfinite(got.mean).all()


def test_climb_leaves_points_without_a_value():
    c = A.Climb([0.0, 1.0])
    f = lambda x: -(x[0] - 3) ** 2 - x[1] ** 2 if x[1] <= 1.0 else np.nan
    for _ in range(40):
        c.tell(np.array([f(p) for p in c.points()]))
    assert np.allclose(c.theta, [3, 0], atol=1e-2) and np.isfinite(c.value)


def test_models_without_coefficients_are_fitted(spark):
    """A random walk's best order is (0, 1, 0), which has nothing to search."""
    r = np.random.default_rng(4)
    named = {"A": 100 + np.cumsum(r.normal(size=120)), "B": 5 + np.cumsum(r.normal(size=90)) * 1e-3}
    got = A.arima_mle(frame(spark, named), max_p=1, max_d=1, max_q=0, rounds=2).collect()
    plain = [g for g in got if (g.p, g.d, g.q) == (0, 1, 0)]
    assert {g.currency for g in plain} == {"A", "B"}
    for g in plain:
        assert g.loglik == pytest.approx(exact_ll(named[g.currency], 1, 0.0, [], []), rel=1e-8)
        assert list(g.ar) == list(g.ma) == [] and g.const == 0


def test_every_accepted_order_is_climbed_to_a_maximum(spark, monkeypatch):
    """All orders of the grid, and no search ends before its top."""
    monkeypatch.setattr(A, "SLICE", 3, raising=False)
    y = walk(150, 23, 10.0, 0.6, 0.3)
    df = frame(spark, {"A": y, None: y[:90]})
    before = {(r.currency, r.p, r.d, r.q): r.loglik for r in A.arima_likelihood(df, max_p=2, max_d=1, max_q=1).collect()}
    got = {(r.currency, r.p, r.d, r.q): r for r in A.arima_mle(df, max_p=2, max_d=1, max_q=1).collect()}
    assert got.keys() == before.keys() and len(got) > 8
    for (k, p, d, q), g in got.items():
        own = y if k == "A" else y[:90]
        mean = g.const / (1 - sum(g.ar)) if d == 0 else 0.0
        assert g.loglik == pytest.approx(exact_ll(own, d, mean, g.ar, g.ma), rel=1e-8, abs=1e-6)
        assert g.loglik >= before[k, p, d, q] - 1e-9
        # a search from here gains nothing
        theta = A._start({"p": p, "d": d, "q": q, "const": g.const, "ar": g.ar, "ma": g.ma})
        c = A.Climb(theta)
        for _ in range(30):
            fits = [A._model({"p": p, "d": d, "q": q}, x) for x in c.points()]
            c.tell(np.array([exact_ll(own, d, m["const"] / (1 - sum(m["ar"])) if d == 0 else 0.0, m["ar"], m["ma"]) for m in fits]))
        assert c.settled and c.value <= g.loglik + 1e-3


def test_climb_goes_on_until_it_settles():
    """A long curved ridge takes more than a few rounds."""
    f = lambda x: -((1 - x[0]) ** 2 + 100 * (x[1] - x[0] ** 2) ** 2)
    c, passes = A.Climb([-1.2, 1.0]), 0
    while not c.settled:
        c.tell(np.array([f(p) for p in c.points()]))
        passes += 1
    assert 8 < passes < 100 and np.allclose(c.theta, 1, atol=1e-2)


def test_one_walk_equals_the_chunks():
    r = np.random.default_rng(6)
    models = A.Models([{"d": d, "p": len(ar), "q": len(ma), "const": 0.3 * (d == 0), "ar": ar, "ma": ma}
                       for d in range(3) for ar, ma in (([], []), ([0.9], [-0.999]), ([0.5, -0.3], [0.4]), ([], [0.2, 0.1, 0.3]))], 4)
    y = np.cumsum(r.normal(size=300))
    for n in (1, 2, 40, 300):
        assert np.allclose(A.plain_sums(y[:n], models), A.carry([A.chunk_maps(y[:n], 0, 0, models)]), rtol=1e-9)
