"""DuckDB SQL of the series regressions: Gram matrices, the sweep operator, and the test statistics,
order search and forecasts built on them.

A least-squares fit is a sequence of sweeps of the Gram matrix of (regressors, response): after sweeping the
first k columns, the response's own entry is the residual sum of squares of the model with k regressors, its
column the coefficients, and the swept block the inverse of X'X.  Nested models thus come from one recursion.
"""

from __future__ import annotations

from ..operators import arima as A
from ..operators import series as X

MAX_P = MAX_D = MAX_Q = 4


def digits(x: str) -> str:
    """``x`` to seven significant digits."""
    return f"CAST(printf('%.6e', {x}) AS DOUBLE)"


def source(rows: str, name: str = "std_") -> str:
    """``name``(currency, n, mean, scale, ys): standardised series as lists, of ``rows`` (currency, t, y)."""
    return f"""{name} AS (SELECT currency, n, mean, scale, list((y - mean) / scale ORDER BY t) AS ys FROM (
  SELECT currency, t, y, count(*) OVER w AS n, avg(y) OVER w AS mean,
         CASE WHEN max(y) OVER w > min(y) OVER w THEN max(y) OVER w - min(y) OVER w ELSE 1.0 END AS scale
  FROM {rows} WINDOW w AS (PARTITION BY currency)) GROUP BY currency, n, mean, scale)"""


def gram(name: str, rows: str, keys: str) -> str:
    """``name``(keys, mx): Gram matrices of ``rows`` (keys, v)."""
    return f"""{name} AS (SELECT {keys}, list(r ORDER BY i) AS mx FROM (
  SELECT {keys}, i, list(x ORDER BY j) AS r FROM (
    SELECT {keys}, i, j, sum(v[i] * v[j]) AS x FROM (
      SELECT {keys}, v, i, unnest(range(1, len(v) + 1)) AS j FROM (SELECT {keys}, v, unnest(range(1, len(v) + 1)) AS i FROM {rows}))
    GROUP BY {keys}, i, j) GROUP BY {keys}, i) GROUP BY {keys})"""


def sweeps(name: str, matrices: str, keys: str, upto: str) -> str:
    """``name``(keys, k, mx): the matrices of ``matrices`` after k sweeps, k = 0 .. ``upto``."""
    m = "list_transform(range(1, len(mx) + 1), lambda i: list_transform(range(1, len(mx) + 1), lambda j: {}))"
    swept = m.format("""CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / mx[k + 1][k + 1]
      WHEN i = k + 1 THEN mx[i][j] / mx[k + 1][k + 1] WHEN j = k + 1 THEN - mx[i][j] / mx[k + 1][k + 1]
      ELSE mx[i][j] - mx[i][k + 1] * mx[k + 1][j] / mx[k + 1][k + 1] END""")
    return f"""{name} AS (SELECT {keys}, 0 AS k, {upto} AS upto, mx FROM {matrices}
  UNION ALL SELECT {keys}, k + 1, upto, {swept} FROM {name} WHERE k < upto)"""


def normal_cdf(z: str) -> str:
    """Distribution function of the normal distribution, by its power series (exact to 1e-14 within 6 deviations)."""
    terms = f"list_reduce(list_transform(range(0, k + 1), lambda i: CASE WHEN i = 0 THEN {z} ELSE {z} * {z} / (2 * i + 1) END), lambda x, y: x * y)"
    return f"(0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120), lambda k: {terms})))"


# --------------------------------------------------------------------------- X3

def adf(crit: str, series: str = "std_") -> str:
    """CTEs up to adf_: one row per series of ``series``."""
    v = """list_concat([1.0, ys[t]], list_transform(range(1, {0} + 1), lambda i: ys[t - i + 1] - ys[t - i]), [ys[t + 1] - ys[t]]) AS v"""
    small = " + ".join(f"{c!r} * stat ** {i}" for i, c in enumerate(X.ADF_SMALLP))
    large = " + ".join(f"{c!r} * stat ** {i}" for i, c in enumerate(X.ADF_LARGEP))
    return f"""o AS (SELECT *, least(ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)::INT AS ml FROM {series}),
a1 AS (SELECT currency, {v.format('ml')} FROM (SELECT currency, ys, ml, unnest(range(ml + 1, n)) AS t FROM o WHERE ml >= 0)),
{gram('a2', 'a1', 'currency')},
{sweeps('a3', 'a2', 'currency', 'len(mx) - 1')},
a4 AS (SELECT a3.currency, k - 2 AS lag, (n - ml - 1) AS nobs, mx[len(mx)][len(mx)] AS ssr, scale FROM a3 JOIN o USING (currency)
  WHERE k >= 2 AND n - ml - 1 > k),
a5 AS (SELECT *, nobs * (ln(2 * pi()) + ln(ssr / nobs) + 1) + 2 * (lag + 2) AS aic FROM a4 WHERE ssr > 0),
a6 AS (SELECT currency, arg_min(lag, (aic, lag)) AS lag, min(aic) + 2 * any_value(nobs) * ln(any_value(scale)) AS icbest FROM a5 GROUP BY currency),
a7 AS (SELECT o.*, coalesce(lag, 0) AS lag, icbest FROM o LEFT JOIN a6 USING (currency)),
a8 AS (SELECT currency, {v.format('lag')} FROM (SELECT currency, ys, lag, unnest(range(lag + 1, n)) AS t FROM a7)),
{gram('a9', 'a8', 'currency')},
{sweeps('a10', 'a9', 'currency', 'len(mx) - 1')},
a11 AS (SELECT a7.currency, lag, icbest, n - lag - 1 AS nobs,
    CASE WHEN n - lag - 1 > lag + 2 AND mx[len(mx)][len(mx)] > 0 THEN mx[2][len(mx)] / sqrt(mx[len(mx)][len(mx)] / (n - 2 * lag - 3) * mx[2][2]) END AS stat
  FROM a7 LEFT JOIN a10 ON a10.currency = a7.currency AND a10.k = a10.upto),
a12 AS (SELECT *, CASE WHEN stat <= {X.ADF_TAU_STAR} THEN {small} ELSE {large} END AS z FROM a11),
adf_ AS (SELECT currency, {digits('stat')} AS adf_stat,
    CASE WHEN stat > {X.ADF_TAU_MAX} THEN 1.0 WHEN stat < {X.ADF_TAU_MIN} THEN 0.0 ELSE round({normal_cdf('z')}, 7) END AS pvalue,
    lag::INT AS usedlag, greatest(nobs, 0)::BIGINT AS nobs, {crit}, {digits('icbest')} AS icbest FROM a12)"""


# --------------------------------------------------------------------------- X8

def ar_linear(features: list[str], win: int) -> str:
    """CTEs up to ar_, from tv."""
    each = " UNION ALL ".join(f"SELECT currency || '|{f}' AS currency, {f} AS y, row_number() OVER (PARTITION BY currency ORDER BY current_time) AS t FROM tv" for f in features)
    return f"""f AS ({each}), {source('f')},
l1 AS (SELECT currency, list_concat([1.0], list_transform(range(1, {win} + 1), lambda i: ys[t + 1 - i]), [ys[t + 1]]) AS v
  FROM (SELECT currency, ys, unnest(range({win}, n)) AS t FROM std_)),
{gram('l2', 'l1', 'currency')},
{sweeps('l3', 'l2', 'currency', 'len(mx) - 1')},
l4 AS (SELECT l3.currency, mean, scale, l3.mx, len(l3.mx) AS y, l2.mx[1][1] AS nobs,
    l2.mx[len(l2.mx)][len(l2.mx)] - l2.mx[1][len(l2.mx)] ** 2 / l2.mx[1][1] AS sst, unnest(range(0, {win} + 1)) AS term
  FROM l3 JOIN l2 USING (currency) JOIN std_ USING (currency) WHERE k = upto),
ar_ AS (SELECT split_part(currency, '|', 1) AS currency, split_part(currency, '|', 2) AS feature, term::INT AS term,
    CASE WHEN term = 0 THEN mean * (1 - list_sum(list_transform(range(2, {win} + 2), lambda i: mx[i][y]))) + scale * mx[1][y] ELSE mx[term + 1][y] END AS coef,
    1 - mx[y][y] / sst AS r2, nobs::BIGINT AS nobs FROM l4)"""


# ----------------------------------------------------------------------- X5, X6

def arima() -> str:
    """CTEs up to grid_ (every fit) and best_ (each series' best one, with its long-AR residuals es), from std_."""
    P, D, Q = MAX_P, MAX_D, MAX_Q
    y = P + Q + 2
    diffs = "".join(f""",
d{d} AS (SELECT currency, {d} AS d, n, m, mean, scale, ys, list_transform(range(1, n + 1), lambda i: CASE WHEN i > 1 THEN ws[i] - ws[i - 1] END) AS ws FROM d{d - 1})"""
                    for d in range(1, D + 1))
    down = "".join(f""",
r{i + 1} AS (SELECT currency, d, p, q, kind, ok AND (len(c) = 0 OR abs(c[len(c)]) < 1) AS ok,
  CASE WHEN len(c) > 1 AND abs(c[len(c)]) < 1 THEN list_transform(range(1, len(c)), lambda i: (c[i] + c[len(c)] * c[len(c) - i]) / (1 - c[len(c)] ** 2)) ELSE [] END AS c FROM r{i})"""
                   for i in range(max(P, Q)))
    return f"""d0 AS (SELECT currency, 0 AS d, n, greatest(floor(ln(n) ** 2)::INT, {2 * max(P, Q)}) AS m, mean, scale, ys, ys AS ws FROM std_){diffs},
w AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM d{d}' for d in range(D + 1))}),
p1 AS (SELECT currency, d, list_concat([1.0], list_transform(range(1, m + 1), lambda i: ws[t + 1 - i]), [ws[t + 1]]) AS v
  FROM (SELECT currency, d, m, ws, unnest(range(d + m, n)) AS t FROM w WHERE n - d - m > m + 1)),
{gram('p2', 'p1', 'currency, d')},
{sweeps('p3', 'p2', 'currency, d', 'len(mx) - 1')},
p4 AS (SELECT currency, d, list_transform(range(1, len(mx)), lambda i: mx[i][len(mx)]) AS a FROM p3 WHERE k = upto),
e AS MATERIALIZED (SELECT w.*, list_transform(range(0, n), lambda t: CASE WHEN t >= d + m THEN
    ws[t + 1] - a[1] - list_sum(list_transform(range(1, m + 1), lambda i: a[i + 1] * ws[t + 1 - i])) END) AS es FROM w JOIN p4 USING (currency, d)),
p6 AS (SELECT currency, d, list_concat([1.0], list_transform(range(1, {P} + 1), lambda i: ws[t + 1 - i]),
    list_transform(range(1, {Q} + 1), lambda i: es[t + 1 - i]), [ws[t + 1]]) AS v
  FROM (SELECT currency, d, ws, es, unnest(range({D} + m + {Q}, n)) AS t FROM e)),
{gram('p7', 'p6', 'currency, d')},
p8 AS (SELECT w.currency, w.d, p, q, mean, scale, mx, coalesce(mx[1][1], 0)::BIGINT AS nobs,
    list_concat(CASE WHEN w.d = 0 THEN [1] ELSE [] END, range(2, p + 2), range({P} + 2, {P} + 2 + q)) AS xs
  FROM (SELECT *, unnest(range(0, {Q} + 1)) AS q FROM (SELECT *, unnest(range(0, {P} + 1)) AS p FROM w)) w
  LEFT JOIN p7 ON p7.currency = w.currency AND p7.d = w.d),
p9 AS (SELECT currency, d, p, q, list_transform(list_append(xs, {y}), lambda i: list_transform(list_append(xs, {y}), lambda j: mx[i][j])) AS mx
  FROM p8 WHERE nobs >= {A.OBS_PER_COEF} * (len(xs) + 1)),
{sweeps('p10', 'p9', 'currency, d, p, q', 'len(mx) - 1')},
p11 AS (SELECT currency, d, p, q, mx[len(mx)][len(mx)] AS ssr, list_transform(range(1, len(mx)), lambda i: mx[i][len(mx)]) AS c FROM p10 WHERE k = upto),
p12 AS MATERIALIZED (SELECT *, CASE WHEN d = 0 THEN c[2:p + 1] ELSE c[1:p] END AS ar, CASE WHEN d = 0 THEN c[p + 2:] ELSE c[p + 1:] END AS ma FROM p11),
r0 AS (SELECT currency, d, p, q, 'ar' AS kind, true AS ok, ar AS c FROM p12
  UNION ALL SELECT currency, d, p, q, 'ma', true, list_transform(ma, lambda x: -x) FROM p12){down},
r AS (SELECT currency, d, p, q, bool_and(ok) FILTER (kind = 'ar') AS ar_ok, bool_and(ok) FILTER (kind = 'ma') AS ma_ok FROM r{max(P, Q)} GROUP BY currency, d, p, q),
g1 AS (SELECT p8.currency, p8.d, p8.p, p8.q, nobs, len(xs) AS kk, mean, scale, ssr / nobs * scale * scale AS sigma2, ar, ma,
    CASE WHEN p8.d = 0 THEN c[1] ELSE 0 END AS const,
    CASE WHEN nobs < {A.OBS_PER_COEF} * (len(xs) + 1) THEN 'too few observations' WHEN NOT ar_ok THEN 'not stationary' WHEN NOT ma_ok THEN 'not invertible' ELSE 'ok' END AS status
  FROM p8 LEFT JOIN p12 USING (currency, d, p, q) LEFT JOIN r USING (currency, d, p, q)),
g2 AS (SELECT *, nobs * (ln(2 * pi() * sigma2) + 1) + 2 * (kk + 1) AS aic FROM g1),
grid_ AS MATERIALIZED (SELECT *, status = 'ok' AND row_number() OVER (PARTITION BY currency ORDER BY CASE WHEN status = 'ok' THEN aic END NULLS LAST, p, d, q) = 1 AS best FROM g2),
best_ AS MATERIALIZED (SELECT grid_.*, e.n, e.m, e.ys, e.ws, e.es FROM grid_ JOIN e USING (currency, d) WHERE best)"""


def fitted() -> str:
    """CTE fit_(currency, t, y, fitted, resid), in standard units, from best_."""
    terms = "const + coalesce(list_sum(list_transform(range(1, p + 1), lambda i: ar[i] * ws[t + 1 - i])), 0) + coalesce(list_sum(list_transform(range(1, q + 1), lambda i: ma[i] * es[t + 1 - i])), 0)"
    return f"""fit_ AS MATERIALIZED (SELECT currency, t, ys[t + 1] AS y, mean, scale, CASE WHEN t >= d + m + q THEN ws[t + 1] - ({terms}) END AS resid
  FROM (SELECT *, unnest(range(0, n)) AS t FROM best_))"""


def forecast(horizon: int) -> str:
    """CTE ahead_(currency, t, fitted) in standard units, from best_ and fit_."""
    binomial = "[[-1], [-2, 1], [-3, 3, -1], [-4, 6, -4, 1]]"
    step = "const + coalesce(list_sum(list_transform(range(1, p + 1), lambda i: ar[i] * wl[i])), 0) + coalesce(list_sum(list_transform(range(1, q + 1), lambda i: ma[i] * el[i])), 0)"
    undo = f"coalesce(list_sum(list_transform(range(1, d + 1), lambda i: {binomial}[d][i] * yl[i])), 0)"
    return f"""l AS (SELECT currency, list(coalesce(resid, 0) ORDER BY t DESC) AS el FROM fit_ GROUP BY currency),
ahead_ AS (SELECT currency, n - 1 AS t, CAST(NULL AS DOUBLE) AS fitted, d, p, q, const, ar, ma, mean, scale, list_reverse(ws)[1:5] AS wl, el[1:5] AS el, list_reverse(ys)[1:5] AS yl, n
  FROM best_ JOIN l USING (currency)
  UNION ALL
  SELECT currency, t + 1, wn - undo, d, p, q, const, ar, ma, mean, scale, list_prepend(wn, wl)[1:5], list_prepend(0.0, el)[1:5], list_prepend(wn - undo, yl)[1:5], n
  FROM (SELECT *, {step} AS wn, {undo} AS undo FROM ahead_ WHERE t < n - 1 + {horizon}))"""
