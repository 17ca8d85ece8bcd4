"""Registered queries: analysis over the wide fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import analysis as A
from ..schemas import MEASURE_COLUMNS
from ..sources.fixtures import feed_table
from . import sqlgen as Q
from .registry import register
from .trade_volume import trade_volume_batch
from .tv import saved_trade_volume

TV = C.TRADE_VOLUME_TABLE
_M = ", ".join(f"round({c}, {Q.R}) AS {c}" for c in MEASURE_COLUMNS)


def _rounded(df, decimals=Q.R):
    return df.select(*[F.round(F.col(f.name), decimals).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@register("tv_min_time", f"WITH {Q.saved_tv_cte()} SELECT min(current_time) AS min_time FROM tv")
def q_tv_min_time(spark, sf_dir):
    """Earliest ``current_time`` of the fact table."""
    return A.min_time(saved_trade_volume(spark, sf_dir))


@register("tv_symbols", f"WITH {Q.saved_tv_cte()} SELECT DISTINCT currency FROM tv")
def q_tv_symbols(spark, sf_dir):
    """Distinct symbols present in the fact table."""
    return A.symbols(saved_trade_volume(spark, sf_dir))


@register("tv_rename_drop", f"WITH {Q.saved_tv_cte()} SELECT currency, {_M}, current_time FROM tv")
def q_tv_rename_drop(spark, sf_dir):
    """Table-qualified result columns shortened to plain names; ``current_day`` dropped."""
    q = A.qualify(saved_trade_volume(spark, sf_dir), TV)
    return _rounded(A.strip_prefix(q, f"{TV}.").drop("current_day"))


@register("tv_split_sorted", f"""WITH {Q.saved_tv_cte()}
SELECT currency, {_M}, current_time,
       row_number() OVER (PARTITION BY currency ORDER BY current_time) - 1 AS t
FROM tv""")
def q_tv_split_sorted(spark, sf_dir):
    """Each symbol's rows ordered by time and numbered 0..n-1."""
    tv = saved_trade_volume(spark, sf_dir).drop("current_day")
    return _rounded(A.split_sorted(tv, "currency", "current_time", "t"))


@register("buy_sell_pressure", f"""WITH {Q.saved_tv_cte()}
SELECT currency, current_time, round(-sell_avg_quantity, {Q.R}) AS neg_sell_avg_quantity,
       round(buy_avg_quantity, {Q.R}) AS buy_avg_quantity,
       round(buy_avg_quantity - sell_avg_quantity, {Q.R}) AS net_avg_quantity
FROM tv""")
def q_buy_sell_pressure(spark, sf_dir):
    """Sell volume mirrored below zero against buy volume, per symbol and day."""
    return _rounded(A.buy_sell_pressure(saved_trade_volume(spark, sf_dir)))


@register("candle_body", f"""WITH {Q.saved_tv_cte()}
SELECT currency, current_time, round(last_cost - first_cost, {Q.R}) AS body FROM tv""")
def q_candle_body(spark, sf_dir):
    """Signed day candle body ``last_cost - first_cost``."""
    return _rounded(A.candle_body(saved_trade_volume(spark, sf_dir)))


def _stamp_sql() -> str:
    parts = [f"p AS (SELECT currency, {', '.join(Q.ohlc_sql())} FROM feed WHERE feed = 'PRICE' GROUP BY currency)"]
    for feed_name, prefix in C.STAT_PREFIX:
        src = (f"(SELECT DISTINCT currency, cost, quantity FROM feed WHERE feed = '{feed_name}')"
               if feed_name in C.BOOK_FEEDS else f"(SELECT * FROM feed WHERE feed = '{feed_name}')")
        parts.append(f"{prefix}_s AS (SELECT currency, {', '.join(Q.stats_sql(prefix))} FROM {src} GROUP BY currency)")
    joins = "p" + "".join(f" JOIN {p}_s USING (currency)" for _, p in C.STAT_PREFIX)
    return f"""WITH {Q.feed_sql()}, {', '.join(parts)}
SELECT *, (SELECT max(ts) FROM feed) AS current_time,
       CAST((SELECT max(ts) FROM feed) AS DATE) AS current_day
FROM {joins}"""


@register("stamp_columns", _stamp_sql())
def q_stamp_columns(spark, sf_dir):
    """Whole input as one batch (reference micro-batch semantics): five
    per-symbol summaries inner-joined on ``currency``, stamped with the batch
    close time and its day."""
    f = feed_table(spark, sf_dir)
    # the batch's processing instant is a parameter of the batch; here it is
    # the batch close time, the latest event instant (one scalar aggregate)
    now = f.agg(F.max(F.col("ts").cast("timestamp_ntz")).alias("now")).first()["now"]
    stamped = trade_volume_batch(f, now)
    return _rounded(stamped)


def _corr_sql() -> str:
    pairs = A.corr_pairs(list(MEASURE_COLUMNS))
    aggs = ", ".join(f"CASE WHEN regr_count({a}, {b}) >= 2 THEN corr({a}, {b}) END AS r{i}"
                     for i, (a, b) in enumerate(pairs))
    entries = ", ".join(f"{{'col_x': '{a}', 'col_y': '{b}', 'r': r{i}}}" for i, (a, b) in enumerate(pairs))
    return f"""WITH {Q.saved_tv_cte()},
w AS (SELECT currency, {aggs} FROM tv GROUP BY currency),
l AS (SELECT currency, unnest([{entries}]) AS e FROM w)
SELECT currency, e.col_x AS col_x, e.col_y AS col_y, round(e.r, {Q.R}) AS r FROM l"""


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf_dir):
    """Per-symbol Pearson correlation of every pair of fact-table measures."""
    return _rounded(A.corr_matrix(saved_trade_volume(spark, sf_dir)))
