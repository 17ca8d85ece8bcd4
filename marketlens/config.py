"""Fixed values of the data model.

Everything in this module is a constant that the results depend on; it is
kept together, in natural order, so it can be checked at a glance.
"""

from __future__ import annotations

# --- fixed values: traded symbols, in configured order -----------------------
SYMBOLS: tuple[str, ...] = (
    "DOGEBTC", "XMRBTC", "ETHBTC", "XRPBTC", "ADABTC",
    "DOGEUSDT", "XMRUSDT", "XRPUSDT", "ADAUSDT", "BTCUSDT", "ETHUSDT",
)

# --- fixed values: feed names (one topic family each) -------------------------
PRICE, BID, ASK, SELL, BUY = "PRICE", "BID", "ASK", "SELL", "BUY"
FEEDS: tuple[str, ...] = (PRICE, BID, ASK, SELL, BUY)
BOOK_FEEDS: tuple[str, ...] = (BID, ASK)      # resting levels, re-sent each poll -> distinct
TRADE_FEEDS: tuple[str, ...] = (SELL, BUY)    # executed trades, every row counts
# column prefix of each statistics feed in the wide table, in column order
STAT_PREFIX: tuple[tuple[str, str], ...] = (
    (BID, "bid"), (ASK, "ask"), (SELL, "sell"), (BUY, "buy"),
)

# --- fixed values: candle intervals (count of buckets per day, step) ----------
CANDLE_INTERVALS: dict[str, tuple[int, str]] = {
    "1m": (1440, "1 minute"),
    "15m": (96, "15 minutes"),
    "1h": (24, "1 hour"),
    "4h": (6, "4 hours"),
    "1d": (1, "1 day"),
}

# --- fixed values: producer polling parameters --------------------------------
PRICE_POLL_SECONDS = 2
BOOK_POLL_SECONDS = 10
BOOK_DEPTH = 200
TRADE_POLL_SECONDS = 10
TRADE_LIMIT = 300

# --- fixed values: micro-batch interval and bounded run length ----------------
MICROBATCH_SECONDS = 60
RUN_CYCLE_MINUTES = 120

# --- fixed values: database, fact table, partition columns (in order) --------
DATABASE = "market_data"
TRADE_VOLUME_TABLE = "trade_volume"
PARTITION_COLUMNS: tuple[str, ...] = ("current_day", "currency")
