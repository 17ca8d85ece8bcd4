"""Registered queries: candles and time grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import timegrid as G
from ..operators import candles as K
from ..operators import stats as S
from ..sources.fixtures import feed_table
from . import sqlgen as Q
from .registry import register
from .tv import saved_trade_volume


def _candle_sql(step: str) -> str:
    return f"""WITH {Q.feed_sql()}
SELECT currency, {', '.join(Q.ohlc_sql())}, count(*) AS ticks,
       {Q.bucket_sql(step)} AS current_time
FROM feed WHERE feed = 'PRICE' GROUP BY {Q.bucket_sql(step)}, currency"""


def _candle_query(name: str, step: str) -> None:
    @register(f"candles_{name}", _candle_sql(step))
    def q(spark, sf_dir):
        return S.finish(K.candles(feed_table(spark, sf_dir), step), Q.R)
    q.__doc__ = f"OHLC candles of the PRICE feed, {step} buckets."


for _name, (_count, _step) in C.CANDLE_INTERVALS.items():
    _candle_query(_name, _step)


@register("candle_grid", f"""WITH {Q.feed_sql()},
p AS (SELECT * FROM feed WHERE feed = 'PRICE'),
span AS (SELECT currency, date_trunc('day', min(ts)) AS d0, date_trunc('day', max(ts)) AS d1
         FROM p GROUP BY currency),
grid AS (SELECT currency, unnest(generate_series(d0, d1 + INTERVAL 1 DAY - INTERVAL 15 MINUTE,
                                                 INTERVAL 15 MINUTE)) AS bucket FROM span),
c AS (SELECT currency, {Q.bucket_sql('15 minutes')} AS bucket, {', '.join(Q.ohlc_sql())},
             count(*) AS ticks
      FROM p GROUP BY currency, {Q.bucket_sql('15 minutes')})
SELECT grid.currency, grid.bucket AS current_time, first_cost, last_cost, max_cost, min_cost,
       coalesce(ticks, 0) AS ticks
FROM grid LEFT JOIN c ON grid.currency = c.currency AND grid.bucket = c.bucket""")
def q_candle_grid(spark, sf_dir):
    """15-minute PRICE candles on the full grid of each symbol's trading days."""
    out = K.candles_filled(feed_table(spark, sf_dir), "15 minutes")
    return S.finish(out, Q.R)


@register("bucket_bounds", f"""WITH {Q.feed_sql()}
SELECT seq, currency, ts,
       time_bucket(INTERVAL 15 MINUTE, ts) AS bucket_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS bucket_end,
       CASE WHEN ts <> time_bucket(INTERVAL 15 MINUTE, ts)
            THEN time_bucket(INTERVAL 15 MINUTE, ts) END AS strict_start,
       CASE WHEN ts <> time_bucket(INTERVAL 15 MINUTE, ts)
            THEN time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE END AS strict_end,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS next_start
FROM feed WHERE feed = 'PRICE'""")
def q_bucket_bounds(spark, sf_dir):
    """Enclosing 15-minute bucket of every PRICE tick (half-open and strict)."""
    f = feed_table(spark, sf_dir).where(F.col("feed") == C.PRICE).select("seq", "currency", "ts")
    b = G.bucket_bounds(f, "ts", "15 minutes")
    return b.select(*[F.col(c).cast("timestamp_ntz").alias(c)
                      if c in ("ts", "bucket_start", "bucket_end", "strict_start", "strict_end", "next_start")
                      else F.col(c) for c in b.columns])


@register("hour_grid", f"""WITH {Q.saved_tv_cte()},
lim AS (SELECT (SELECT date_trunc('hour', min(current_time)) FROM tv) AS h0,
               (SELECT date_trunc('hour', max(ts)) FROM feed) AS h1)
SELECT unnest(generate_series(h0, h1, INTERVAL 1 HOUR)) AS hour FROM lim""")
def q_hour_grid(spark, sf_dir):
    """Hourly points from the earliest fact row to the latest event."""
    tv = saved_trade_volume(spark, sf_dir).select(F.col("current_time").alias("_a"),
                                                  F.lit(None).cast("timestamp_ntz").alias("_b"))
    ev = feed_table(spark, sf_dir).select(F.lit(None).cast("timestamp_ntz").alias("_a"),
                                          F.col("ts").cast("timestamp_ntz").alias("_b"))
    return G.hour_grid(tv.unionByName(ev), "_a", "_b")


@register("hour_grid_days", f"""WITH {Q.saved_tv_cte()},
lim AS (SELECT (SELECT date_trunc('hour', min(current_time)) FROM tv) AS h0,
               (SELECT date_trunc('hour', max(ts)) FROM feed) AS h1)
SELECT unnest(generate_series(h0, h0 + to_days(CAST(floor(epoch(h1 - h0) / 86400) AS INTEGER)),
                              INTERVAL 1 HOUR)) AS hour FROM lim""")
def q_hour_grid_days(spark, sf_dir):
    """Hourly points over the whole days of the span plus the start point
    (days * 24 + 1 points, the count the reference script prints)."""
    tv = saved_trade_volume(spark, sf_dir).select(F.col("current_time").alias("_a"),
                                                  F.lit(None).cast("timestamp_ntz").alias("_b"))
    ev = feed_table(spark, sf_dir).select(F.lit(None).cast("timestamp_ntz").alias("_a"),
                                          F.col("ts").cast("timestamp_ntz").alias("_b"))
    return G.hour_grid(tv.unionByName(ev), "_a", "_b", whole_days=True)
