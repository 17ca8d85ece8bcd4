"""Registry of named queries: ``name -> (spark callable, oracle SQL or None)``.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables (or data Spark derives from them).  Output columns are
aliased identically on both sides; timestamps leave as TIMESTAMP_NTZ and
double statistics are rounded to 8 decimals for the value comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import stats as S
from ..session import SESSION_DEFAULTS, settings, ship_package
from ..sources.fixtures import feed_table
from . import sqlgen as Q
from .trade_volume import trade_volume_fold, trade_volume_onepass

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # plans resolve their time zone when they are built; the caller's settings come back
            ship_package(spark)
            with settings(spark, SESSION_DEFAULTS):
                return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return run
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Double columns to the decimals that both sides compare."""
    return df.select(*[F.round(F.col(f.name), Q.R).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def _feed(spark: SparkSession, sf_dir: str, step: str = "1 day") -> DataFrame:
    return S.with_bucket(feed_table(spark, sf_dir), step)


# --------------------------------------------------------------------------
# The wide fact row
# --------------------------------------------------------------------------

@register("trade_volume_onepass", Q.trade_volume())
def q_trade_volume_onepass(spark, sf_dir):
    """Wide trade_volume row per (day, symbol): one aggregate, no join."""
    return trade_volume_onepass(feed_table(spark, sf_dir), "1 day", decimals=Q.R)


@register("trade_volume", Q.trade_volume())
def q_trade_volume(spark, sf_dir):
    """Wide trade_volume row per (day, symbol): five summaries, inner-join fold."""
    return trade_volume_fold(feed_table(spark, sf_dir), "1 day", decimals=Q.R)


# --------------------------------------------------------------------------
# Per-feed summaries
# --------------------------------------------------------------------------

@register("price_ohlc", f"""WITH {Q.rows_sql()}
SELECT currency, {', '.join(Q.ohlc_sql())}, bucket AS current_time
FROM rows_ WHERE feed = 'PRICE' GROUP BY bucket, currency""")
def q_price_ohlc(spark, sf_dir):
    """Open/close/high/low of PRICE per day and symbol."""
    return S.finish(S.price_ohlc(_feed(spark, sf_dir)), Q.R)


def _stats_query(feed_name: str, prefix: str) -> None:
    sql = f"""WITH {Q.rows_sql()}
SELECT currency, {', '.join(Q.stats_sql(prefix))}, bucket AS current_time
FROM rows_ WHERE feed = '{feed_name}' GROUP BY bucket, currency"""

    @register(f"{prefix}_stats", sql)
    def q(spark, sf_dir):
        return S.finish(S.order_stats(_feed(spark, sf_dir), feed_name, prefix), Q.R)
    q.__doc__ = f"Seven statistics of the {feed_name} feed per day and symbol."


for _feed_name, _prefix in C.STAT_PREFIX:
    _stats_query(_feed_name, _prefix)


@register("distinct_orders", f"""WITH {Q.feed_sql()},
b AS (SELECT *, {Q.bucket_sql('1 day')} AS bucket FROM feed)
SELECT DISTINCT currency, feed, cost, quantity, bucket AS current_time
FROM b WHERE feed IN ('BID', 'ASK')""")
def q_distinct_orders(spark, sf_dir):
    """Whole-row distinct of order-book levels within each day."""
    f = _feed(spark, sf_dir)
    levels = S.distinct_levels(f.where(f.feed.isin(*C.BOOK_FEEDS)))
    return S.finish(levels.select("currency", "feed", "cost", "quantity", "window"))


@register("join_using", f"""WITH {Q.rows_sql()},
p AS (SELECT bucket, currency, {', '.join(Q.ohlc_sql())} FROM rows_
      WHERE feed = 'PRICE' GROUP BY bucket, currency),
s AS (SELECT bucket, currency, {', '.join(Q.stats_sql('bid'))} FROM rows_
      WHERE feed = 'BID' GROUP BY bucket, currency)
SELECT p.currency, first_cost, last_cost, max_cost, min_cost,
       {', '.join('bid_' + x for x in Q.STAT_SUFFIXES)}, p.bucket AS current_time
FROM p JOIN s USING (bucket, currency)""")
def q_join_using(spark, sf_dir):
    """Inner USING join of the PRICE summary and the BID summary."""
    f = _feed(spark, sf_dir)
    j = S.join_using(S.price_ohlc(f), S.order_stats(f, C.BID, "bid"), S.GROUP_KEYS)
    return S.finish(j, Q.R)


def _join_fold_sql() -> str:
    parts, names = [], []
    for feed_name, prefix in C.STAT_PREFIX:
        parts.append(f"""{prefix}_s AS (SELECT bucket, currency, {', '.join(Q.stats_sql(prefix))}
      FROM rows_ WHERE feed = '{feed_name}' GROUP BY bucket, currency)""")
        names.append(f"{prefix}_s")
    joins = names[0] + "".join(f" JOIN {n} USING (bucket, currency)" for n in names[1:])
    cols = ", ".join(f"{p}_{x}" for _, p in C.STAT_PREFIX for x in Q.STAT_SUFFIXES)
    return f"""WITH {Q.rows_sql()},
{', '.join(parts)}
SELECT currency, {cols}, bucket AS current_time FROM {joins}"""


@register("join_fold", _join_fold_sql())
def q_join_fold(spark, sf_dir):
    """Four-way inner-join fold of the BID/ASK/SELL/BUY summaries."""
    f = _feed(spark, sf_dir)
    frames = [S.order_stats(f, n, p) for n, p in C.STAT_PREFIX]
    return S.finish(S.join_fold(frames, S.GROUP_KEYS), Q.R)
