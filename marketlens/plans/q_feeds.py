"""Registered queries: feed-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import feeds as FD
from ..sources.fixtures import feed_table, order_books, raw_trades
from . import sqlgen as Q
from .registry import register

# --- fixed values: the symbol list of the reference's analysis CSV ------------
CSV_SYMBOLS = "DOGEBTC,XMRBTC,ETHBTC,XRPBTC,ADABTC,BTCUSD,ETHUSD"


def _ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


def _routed_trades(spark, sf_dir):
    return FD.route_trades(raw_trades(feed_table(spark, sf_dir)))


_SYMS_SQL = ", ".join(f"'{s}'" for s in FD.parse_symbols(CSV_SYMBOLS))


@register("filter_symbols", f"""WITH {Q.feed_sql()}
SELECT seq, currency, feed, cost, quantity, ts FROM feed WHERE currency IN ({_SYMS_SQL})""")
def q_filter_symbols(spark, sf_dir):
    """Feed rows of the configured symbols only (comma list from config)."""
    f = feed_table(spark, sf_dir)
    out = FD.filter_symbols(f, FD.parse_symbols(CSV_SYMBOLS))
    return out.select("seq", "currency", "feed", "cost", "quantity", _ntz("ts"))


_ROUTED_SQL = f"""WITH {Q.feed_sql()},
raw AS (SELECT seq, currency, CAST(cost AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS qty,
               seq % 2 = 0 AS is_buyer_maker, ts FROM feed WHERE feed IN ('SELL', 'BUY')),
routed AS (SELECT seq, currency, CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS feed,
                  CAST(price AS DOUBLE) AS cost, CAST(CAST(qty AS FLOAT) AS DOUBLE) AS quantity, ts
           FROM raw)"""


@register("route_trades", f"{_ROUTED_SQL} SELECT * FROM routed")
def q_route_trades(spark, sf_dir):
    """Raw trades routed to SELL (buyer is maker) or BUY, text numbers typed."""
    r = _routed_trades(spark, sf_dir)
    return r.select("seq", "currency", "feed", "cost", "quantity", _ntz("ts"))


@register("recent_trades", f"""{_ROUTED_SQL},
ranked AS (SELECT *, time_bucket(INTERVAL 10 SECOND, ts) AS poll_start,
                  row_number() OVER (PARTITION BY currency, time_bucket(INTERVAL 10 SECOND, ts)
                                     ORDER BY ts, seq) AS rn FROM routed)
SELECT seq, currency, feed, cost, quantity, ts, poll_start FROM ranked WHERE rn <= {C.TRADE_LIMIT}""")
def q_recent_trades(spark, sf_dir):
    """Trades answered per 10-second poll window: at most 300 per symbol and
    window, oldest first."""
    r = FD.poll_limited(_routed_trades(spark, sf_dir))
    return r.select("seq", "currency", "feed", "cost", "quantity", _ntz("ts"), _ntz("poll_start"))


_BOOK_SQL = f"""WITH {Q.feed_sql()},
lv AS (SELECT time_bucket(INTERVAL {C.BOOK_POLL_SECONDS} SECOND, ts) AS snapshot, currency, feed AS side,
              cost AS price, quantity AS qty FROM feed WHERE feed IN ('BID', 'ASK'))"""


@register("book_explode", f"""{_BOOK_SQL}
SELECT snapshot, currency, side,
       row_number() OVER (PARTITION BY snapshot, currency, side ORDER BY
         CASE WHEN side = 'BID' THEN -price ELSE price END,
         CASE WHEN side = 'BID' THEN -qty ELSE qty END) - 1 AS level,
       price, CAST(CAST(qty AS FLOAT) AS DOUBLE) AS qty
FROM lv""")
def q_book_explode(spark, sf_dir):
    """Order-book snapshots (one per poll) flattened to one row per level and side."""
    lv = FD.book_explode(order_books(feed_table(spark, sf_dir)))
    return lv.select(_ntz("snapshot"), "currency", "side", "level", "price", "qty")


@register("book_top_n", f"""{_BOOK_SQL},
r AS (SELECT snapshot, currency, side, price, CAST(CAST(qty AS FLOAT) AS DOUBLE) AS qty,
             row_number() OVER (PARTITION BY snapshot, currency, side ORDER BY
               CASE WHEN side = 'BID' THEN -price ELSE price END, qty DESC) AS rank
      FROM lv)
SELECT * FROM r WHERE rank <= {C.BOOK_DEPTH}""")
def q_book_top_n(spark, sf_dir):
    """Best 200 levels per snapshot, symbol and side."""
    lv = FD.book_explode(order_books(feed_table(spark, sf_dir)))
    top = FD.book_top_n(lv, C.BOOK_DEPTH)
    return top.select(_ntz("snapshot"), "currency", "side", "price", "qty", "rank")


DAY_TRADES, DAY_LEVELS = 5, 3      # small enough to cut rows of the test tables


@register("recent_trades_per_day", f"""{_ROUTED_SQL},
ranked AS (SELECT *, date_trunc('day', ts) AS poll_start,
                  row_number() OVER (PARTITION BY currency, date_trunc('day', ts) ORDER BY ts, seq) AS rn FROM routed)
SELECT seq, currency, feed, cost, quantity, ts, poll_start FROM ranked WHERE rn <= {DAY_TRADES}""")
def q_recent_trades_per_day(spark, sf_dir):
    """The first 5 trades per symbol and day: the per-poll limit with a long window."""
    r = FD.poll_limited(_routed_trades(spark, sf_dir), "1 day", DAY_TRADES)
    return r.select("seq", "currency", "feed", "cost", "quantity", _ntz("ts"), _ntz("poll_start"))


@register("book_best_per_day", f"""WITH {Q.feed_sql()},
lv AS (SELECT date_trunc('day', ts) AS snapshot, currency, feed AS side, cost AS price,
              CAST(CAST(quantity AS FLOAT) AS DOUBLE) AS qty FROM feed WHERE feed IN ('BID', 'ASK')),
r AS (SELECT *, row_number() OVER (PARTITION BY snapshot, currency, side ORDER BY
               CASE WHEN side = 'BID' THEN -price ELSE price END, qty DESC) AS rank FROM lv)
SELECT snapshot, currency, side, price, qty, rank FROM r WHERE rank <= {DAY_LEVELS}""")
def q_book_best_per_day(spark, sf_dir):
    """Best 3 levels per symbol and side of day-long book snapshots."""
    lv = FD.book_explode(order_books(feed_table(spark, sf_dir), "1 day"))
    return FD.book_top_n(lv, DAY_LEVELS).select(_ntz("snapshot"), "currency", "side", "price", "qty", "rank")


@register("trades_in_range", f"""{_ROUTED_SQL}
SELECT * FROM routed WHERE ts BETWEEN (SELECT max(ts) FROM routed) - INTERVAL {C.TRADE_POLL_SECONDS} SECOND
  AND (SELECT max(ts) FROM routed)""")
def q_trades_in_range(spark, sf_dir):
    """Trades of the last poll interval, [t0 - 10 s, t0] with t0 the latest trade."""
    r = _routed_trades(spark, sf_dir)
    end = r.agg(F.max("ts").alias("t0")).first()["t0"]
    got = FD.in_time_range(r, F.lit(end), f"{C.TRADE_POLL_SECONDS} SECONDS")
    return got.select("seq", "currency", "feed", "cost", "quantity", _ntz("ts"))


@register("latest_by_symbol", f"""WITH {Q.feed_sql()}
SELECT currency, feed, last(cost ORDER BY us, seq) AS cost, last(quantity ORDER BY us, seq) AS quantity,
       last(ts ORDER BY us, seq) AS ts, last(seq ORDER BY us, seq) AS seq
FROM feed GROUP BY currency, feed""")
def q_latest_by_symbol(spark, sf_dir):
    """Latest value of every feed per symbol (what a new subscriber is
    replayed first)."""
    latest = FD.latest_by_key(feed_table(spark, sf_dir))
    return latest.select("currency", "feed", "cost", "quantity", _ntz("ts"), "seq")
