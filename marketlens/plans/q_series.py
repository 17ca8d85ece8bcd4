"""Registered queries: per-symbol series analysis of the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normal import norm_ppf_sql
from ..operators import arima as A
from ..operators import series as X
from . import sql_series as S
from . import sqlgen as Q
from .registry import register, rounded
from .tv import saved_trade_volume

NLAGS = 10
FEATURES = ["first_cost", "buy_avg_quantity", "sell_avg_quantity"]
WIN = 4


def _digits(df, *names):
    """The named columns to seven significant digits."""
    return df.withColumns({n: F.when(F.col(n).isNotNull(), F.format_string("%.6e", n).cast("double")) for n in names})


def _series_cte(value: str = "first_cost") -> str:
    return f"""{Q.saved_tv_cte()},
s AS (SELECT currency, {value} AS y,
             row_number() OVER (PARTITION BY currency ORDER BY current_time) - 1 AS t
      FROM tv WHERE {value} IS NOT NULL)"""


def _acf_cte(nlags: int = NLAGS, series: str | None = None) -> str:
    """acf_ of s; ``series`` are the CTEs up to s (none if they stand already)."""
    before = _series_cte() + "," if series is None else series
    return f"""{before}
m AS (SELECT currency, avg(y) AS mu FROM s GROUP BY currency),
d AS (SELECT s.currency, t, y - mu AS d FROM s JOIN m USING (currency)),
c0 AS (SELECT currency, sum(d * d) AS c0 FROM d GROUP BY currency),
ck AS (SELECT a.currency, a.t - b.t AS lag, sum(a.d * b.d) AS ck
       FROM d a JOIN d b ON b.currency = a.currency AND b.t <= a.t AND a.t - b.t <= {nlags}
       GROUP BY a.currency, a.t - b.t),
grid AS (SELECT currency, c0, unnest(range(0, {nlags + 1})) AS lag FROM c0),
acf_ AS (SELECT grid.currency, CAST(grid.lag AS INTEGER) AS lag,
                CASE WHEN c0 <> 0 THEN ck / c0 END AS acf
         FROM grid LEFT JOIN ck ON ck.currency = grid.currency AND ck.lag = grid.lag)"""


@register("acf", f"WITH {_acf_cte()} SELECT currency, lag, round(acf, {Q.R}) AS acf FROM acf_")
def q_acf(spark, sf_dir):
    """Autocorrelation of each symbol's daily first price, lags 0..10."""
    return rounded(X.acf(saved_trade_volume(spark, sf_dir), nlags=NLAGS))


_PACF_CTE = f"""rl AS (SELECT currency, list(acf ORDER BY lag) AS r FROM acf_ GROUP BY currency),
dl AS (
  SELECT currency, 1 AS k, [r[2]] AS phi, r[2] AS pkk, r FROM rl
  UNION ALL
  SELECT currency, k + 1 AS k,
         list_append(list_transform(range(1, k + 1), lambda j: phi[j] - pk * phi[k + 1 - j]), pk) AS phi, pk AS pkk, r
  FROM (SELECT currency, k, phi, r,
               (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])))
               / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1]))) AS pk
        FROM dl WHERE k < {{nlags}}))"""


@register("pacf", f"""WITH RECURSIVE {_acf_cte()},
{_PACF_CTE.format(nlags=NLAGS)}
SELECT currency, 0 AS lag, 1.0::DOUBLE AS pacf FROM rl
UNION ALL SELECT currency, k AS lag, round(pkk, {Q.R}) AS pacf FROM dl""")
def q_pacf(spark, sf_dir):
    """Partial autocorrelation (Durbin-Levinson on the ACF), lags 0..10."""
    a = X.acf(saved_trade_volume(spark, sf_dir), nlags=NLAGS)
    return rounded(X.pacf(a))


def _crit_sql(n: str) -> str:
    out = []
    for name, c in X.ADF_CRIT_C.items():
        col = {"1%": "crit_1pct", "5%": "crit_5pct", "10%": "crit_10pct"}[name]
        out.append(f"CASE WHEN {n} > 0 THEN round({c[0]!r} + {c[1]!r} / {n} + {c[2]!r} / ({n} * {n}) "
                   f"+ {c[3]!r} / ({n} * {n} * {n}), {Q.R}) END AS {col}")
    return ", ".join(out)


def _qq_cte(rows: str) -> str:
    """z: ranked values of ``rows`` (currency, y) with their normal quantiles."""
    return f"""rank_ AS (SELECT currency, y AS sample, row_number() OVER (PARTITION BY currency ORDER BY y) AS i,
             count(*) OVER (PARTITION BY currency) AS n, avg(y) OVER (PARTITION BY currency) AS mu,
             stddev_pop(y) OVER (PARTITION BY currency) AS sd FROM {rows}),
z AS (SELECT *, i / (n + 1) AS p, {norm_ppf_sql('i / (n + 1)')} AS z FROM rank_)"""


def _correlogram_sql(nlags: int) -> str:
    """From acf_ and s."""
    return f"""{_PACF_CTE.format(nlags=nlags)},
n_ AS (SELECT currency, count(*) AS n FROM s GROUP BY currency),
bands_ AS (SELECT acf_.currency, acf_.lag, acf, n,
             coalesce(sum(CASE WHEN acf_.lag > 0 THEN acf * acf ELSE 0 END) OVER (
               PARTITION BY acf_.currency ORDER BY acf_.lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r2
      FROM acf_ JOIN n_ USING (currency))
SELECT bands_.currency, bands_.lag, round(bands_.acf, {Q.R}) AS acf,
       round(CASE WHEN bands_.lag > 0 THEN {X.Z95!r} * sqrt((1 + 2 * r2) / n) ELSE 0.0::DOUBLE END, {Q.R}) AS acf_band,
       round(CASE WHEN bands_.lag > 0 THEN pkk ELSE 1.0::DOUBLE END, {Q.R}) AS pacf,
       round(CASE WHEN bands_.lag > 0 THEN {X.Z95!r} / sqrt(n) ELSE 0.0::DOUBLE END, {Q.R}) AS pacf_band
FROM bands_ LEFT JOIN dl ON dl.currency = bands_.currency AND dl.k = bands_.lag"""


@register("correlogram", f"WITH RECURSIVE {_acf_cte()},\n{_correlogram_sql(NLAGS)}")
def q_correlogram(spark, sf_dir):
    """Autocorrelation and partial autocorrelation with their 95 % bands, lags 0..10."""
    return rounded(X.correlogram(saved_trade_volume(spark, sf_dir), nlags=NLAGS))


def _residuals(spark, sf_dir):
    """Residuals of each symbol's best ARIMA model."""
    fit = A.arima_forecast(saved_trade_volume(spark, sf_dir), horizon=1)
    return fit.where("kind = 'fit' AND resid IS NOT NULL").select("currency", "t", "resid")


def _residuals_cte(name: str = "s") -> str:
    return f"""{_series_cte().replace('s AS (SELECT', 'prices AS (SELECT')},
{S.source('prices')}, {S.arima()}, {S.fitted()},
{name} AS (SELECT currency, scale * resid AS y, row_number() OVER (PARTITION BY currency ORDER BY t) - 1 AS t FROM fit_ WHERE resid IS NOT NULL)"""


RESIDUAL_LAGS = 30


@register("arima_residual_correlogram", f"""WITH RECURSIVE {_residuals_cte()},
{_acf_cte(RESIDUAL_LAGS, '')},
{_correlogram_sql(RESIDUAL_LAGS).replace(f', {Q.R})', ', 5)')}""")
def q_arima_residual_correlogram(spark, sf_dir):
    """Correlogram with bands of the residuals of each symbol's best ARIMA model, lags 0..30."""
    c = X.correlogram(_residuals(spark, sf_dir), order="t", value="resid", nlags=RESIDUAL_LAGS)
    return c.select("currency", "lag", *[F.round(x, 5).alias(x) for x in ("acf", "acf_band", "pacf", "pacf_band")])


@register("arima_residual_qq", f"""WITH RECURSIVE {_residuals_cte()},
{_qq_cte('s')}
SELECT currency, i, round(p, {Q.R}) AS p, round(z, {Q.R}) AS z, {S.digits('sample')} AS sample, {S.digits('z * sd + mu')} AS fit FROM z""")
def q_arima_residual_qq(spark, sf_dir):
    """Normal Q-Q points of the residuals of each symbol's best ARIMA model."""
    q = X.qq_points(_residuals(spark, sf_dir), value="resid")
    return _digits(q.withColumns({c: F.round(c, Q.R) for c in ("p", "z")}), "sample", "fit")


@register("arima_residual_adf", f"""WITH RECURSIVE {_residuals_cte()},
{S.source('s', 'resid_')}, {S.adf(_crit_sql('nobs'), 'resid_')}
SELECT *, CAST(NULL AS VARCHAR) AS error FROM adf_""")
def q_arima_residual_adf(spark, sf_dir):
    """Augmented Dickey-Fuller test of the residuals of each symbol's best ARIMA model, lag order by AIC."""
    return _adf_rounded(X.adf(_residuals(spark, sf_dir), order="t", value="resid"))


def _adf_rounded(a):
    crit = {c: F.round(c, Q.R) for c in ("crit_1pct", "crit_5pct", "crit_10pct")}
    return _digits(a.withColumns({**crit, "pvalue": F.round("pvalue", 7)}), "adf_stat", "icbest")


@register("adf", f"""WITH RECURSIVE {_series_cte()},
{S.source('s')}, {S.adf(_crit_sql('nobs'))}
SELECT *, CAST(NULL AS VARCHAR) AS error FROM adf_""")
def q_adf(spark, sf_dir):
    """Augmented Dickey-Fuller test of each symbol's daily first price,
    lag order chosen by AIC."""
    return _adf_rounded(X.adf(saved_trade_volume(spark, sf_dir)))


@register("adf_lag0", f"""WITH {_series_cte()},
l AS (SELECT currency, y - lag(y) OVER w AS dy, lag(y) OVER w AS ylag
      FROM s WINDOW w AS (PARTITION BY currency ORDER BY t)),
r AS (SELECT currency, regr_sxx(dy, ylag) AS sxx, regr_syy(dy, ylag) AS syy,
             regr_sxy(dy, ylag) AS sxy, CAST(regr_count(dy, ylag) AS BIGINT) AS n
      FROM l WHERE ylag IS NOT NULL GROUP BY currency),
k AS (SELECT DISTINCT currency FROM s),
a AS (SELECT k.currency, sxx, syy, sxy, coalesce(n, 0) AS n FROM k LEFT JOIN r USING (currency))
SELECT currency,
       CASE WHEN n > 2 AND sxx > 0 AND syy - sxy * sxy / sxx > 0
            THEN round((sxy / sxx) / sqrt(((syy - sxy * sxy / sxx) / (n - 2)) / sxx), {Q.R}) END AS adf_stat,
       0 AS usedlag, n AS nobs,
       {_crit_sql('n')}
FROM a""")
def q_adf_lag0(spark, sf_dir):
    """Dickey-Fuller regression without augmentation lags (fixed lag 0)."""
    a = X.adf(saved_trade_volume(spark, sf_dir), maxlag=0, autolag=None)
    return rounded(a.select("currency", "adf_stat", "usedlag", "nobs",
                             "crit_1pct", "crit_5pct", "crit_10pct"))


@register("qq_points", f"""WITH {_series_cte()},
{_qq_cte('s')}
SELECT currency, i, round(p, {Q.R}) AS p, round(z, {Q.R}) AS z, round(sample, {Q.R}) AS sample,
       round(z * sd + mu, {Q.R}) AS fit FROM z""")
def q_qq_points(spark, sf_dir):
    """Normal Q-Q points of each symbol's daily first price."""
    return rounded(X.qq_points(saved_trade_volume(spark, sf_dir)))


def _lag_sql() -> str:
    cols = [f"round({f}, {Q.R}) AS {f}_lag0" for f in FEATURES]
    cols += [f"round(lag({f}, {k}) OVER w, {Q.R}) AS {f}_lag{k}" for f in FEATURES for k in range(1, WIN)]
    return f"""WITH {Q.saved_tv_cte()},
x AS (SELECT currency, current_time,
             row_number() OVER w - 1 AS t, {', '.join(cols)}
      FROM tv WINDOW w AS (PARTITION BY currency ORDER BY current_time))
SELECT * FROM x WHERE t >= {WIN - 1}"""


@register("lag_features", _lag_sql())
def q_lag_features(spark, sf_dir):
    """Sliding windows of the last 4 days of three features per symbol."""
    return rounded(X.lag_features(saved_trade_volume(spark, sf_dir), FEATURES, WIN))


@register("ar_linear", f"""WITH RECURSIVE {Q.saved_tv_cte()},
{S.ar_linear(FEATURES, WIN)}
SELECT currency, feature, term, {S.digits('coef')} AS coef, {S.digits('r2')} AS r2, nobs, CAST(NULL AS VARCHAR) AS error FROM ar_""")
def q_ar_linear(spark, sf_dir):
    """Per symbol and feature, a linear autoregression on the last 4 values."""
    return _digits(X.ar_linear(saved_trade_volume(spark, sf_dir), FEATURES, WIN), "coef", "r2")


@register("arima_grid", f"""WITH RECURSIVE {_series_cte()},
{S.source('s')}, {S.arima()}
SELECT currency, p::INT AS p, d::INT AS d, q::INT AS q, {S.digits('aic')} AS aic, {S.digits('sigma2')} AS sigma2, nobs, status, best FROM grid_""")
def q_arima_grid(spark, sf_dir):
    """ARIMA(p, d, q) search, p, d, q in 0..4, per symbol; least AIC marked."""
    return _digits(A.arima_grid(saved_trade_volume(spark, sf_dir)), "aic", "sigma2")


@register("arima_likelihood", None)
def q_arima_likelihood(spark, sf_dir):
    """Exact Gaussian log-likelihood of every accepted ARIMA fit; best order by it."""
    return A.arima_likelihood(saved_trade_volume(spark, sf_dir))


@register("arima_mle", None)
def q_arima_mle(spark, sf_dir):
    """Every accepted ARIMA order of each symbol, fitted by maximum exact likelihood; best order by it."""
    return A.arima_mle(saved_trade_volume(spark, sf_dir))


@register("arima_forecast", f"""WITH RECURSIVE {_series_cte()},
{S.source('s')}, {S.arima()}, {S.fitted()}, {S.forecast(1000)}
SELECT currency, t::BIGINT AS t, 'fit' AS kind, {S.digits('mean + scale * y')} AS y, {S.digits('mean + scale * (y - resid)')} AS fitted,
       round(scale * resid, 5) AS resid FROM fit_
UNION ALL SELECT currency, t::BIGINT, 'forecast', NULL, {S.digits('mean + scale * fitted')}, NULL FROM ahead_ WHERE fitted IS NOT NULL""")
def q_arima_forecast(spark, sf_dir):
    """Fitted values, residuals and 1000 forecasts of each symbol's best model."""
    f = A.arima_forecast(saved_trade_volume(spark, sf_dir), horizon=1000)
    return _digits(f.withColumn("resid", F.round("resid", 5)), "y", "fitted")
