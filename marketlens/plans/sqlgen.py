"""DuckDB SQL text for the oracle comparison.

Each builder returns an independent formulation of a query over the
driver's tables, written directly in SQL (DISTINCT, FILTER, ordered
aggregates, window functions) rather than generated from the Spark plan.
"""

from __future__ import annotations

from .. import config as C
from ..schemas import STAT_SUFFIXES  # noqa: F401  (re-exported)
from ..sources.fixtures import feed_sql  # noqa: F401  (re-exported)

R = 8  # decimals both sides round statistics to


def bucket_sql(step: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{step}', {ts})"


def rows_sql(step: str = "1 day") -> str:
    """CTEs ``feed`` (mapped events), ``b`` (bucketed) and ``rows_`` (book
    levels made distinct per bucket, other feeds unchanged)."""
    book = ", ".join(f"'{x}'" for x in C.BOOK_FEEDS)
    return f"""{feed_sql()},
b AS (SELECT *, {bucket_sql(step)} AS bucket FROM feed),
rows_ AS (
  SELECT DISTINCT bucket, currency, feed, cost, quantity,
         CAST(NULL AS BIGINT) AS us, CAST(NULL AS BIGINT) AS seq
  FROM b WHERE feed IN ({book})
  UNION ALL
  SELECT bucket, currency, feed, cost, quantity, us, seq
  FROM b WHERE feed NOT IN ({book}))"""


def ohlc_sql(where: str | None = None, decimals: int | None = R) -> list[str]:
    flt = f" FILTER (WHERE {where})" if where else ""
    exprs = {
        "first_cost": f"first(cost ORDER BY us, seq){flt}",
        "last_cost": f"last(cost ORDER BY us, seq){flt}",
        "max_cost": f"max(cost){flt}",
        "min_cost": f"min(cost){flt}",
    }
    return [f"round({e}, {decimals}) AS {n}" if decimals is not None else f"{e} AS {n}"
            for n, e in exprs.items()]


def stats_sql(prefix: str, where: str | None = None, decimals: int | None = R) -> list[str]:
    flt = f" FILTER (WHERE {where})" if where else ""
    fns = {
        "avg_cost": "avg(cost)", "std_cost": "stddev_samp(cost)", "var_cost": "var_samp(cost)",
        "sum_quantity": "sum(quantity)", "avg_quantity": "avg(quantity)",
        "std_quantity": "stddev_samp(quantity)", "var_quantity": "var_samp(quantity)",
    }
    out = []
    for s in STAT_SUFFIXES:
        e = fns[s] + flt
        out.append(f"round({e}, {decimals}) AS {prefix}_{s}" if decimals is not None
                   else f"{e} AS {prefix}_{s}")
    return out


def trade_volume_cte(step: str = "1 day", name: str = "tv", decimals: int | None = R) -> str:
    """CTE text ending with ``{name}`` = the 35-column wide table."""
    aggs = ohlc_sql("feed = 'PRICE'", decimals)
    for feed, prefix in C.STAT_PREFIX:
        aggs += stats_sql(prefix, f"feed = '{feed}'", decimals)
    having = " AND ".join(f"count(*) FILTER (WHERE feed = '{f}') > 0" for f in C.FEEDS)
    return f"""{rows_sql(step)},
{name} AS (
  SELECT currency, {', '.join(aggs)},
         bucket AS current_time, CAST(bucket AS DATE) AS current_day
  FROM rows_ GROUP BY bucket, currency
  HAVING {having})"""


def trade_volume(step: str = "1 day") -> str:
    return f"WITH {trade_volume_cte(step)} SELECT * FROM tv"


def saved_tv_cte() -> str:
    """The saved fact table (unrounded, day buckets) as CTE ``tv``."""
    return trade_volume_cte("1 day", "tv", None)


def measures(prefix: str = "") -> list[str]:
    from ..schemas import MEASURE_COLUMNS
    return [prefix + c for c in MEASURE_COLUMNS]
