"""Scalar column expressions used at the edges (wire format, numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column | str) -> Column:
    """String -> double; NULL (not an error) when the text is not a number."""
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


def narrow_to_float(c: Column | str) -> Column:
    """String/double -> float -> double: the precision a 32-bit float keeps
    (``'0.1'`` -> ``0.10000000149011612``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("float").cast("double")


def epoch_millis_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP (UTC session zone)."""
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def topic_of(feed: Column | str, currency: Column | str) -> Column:
    """``FEED_SYMBOL`` topic name."""
    return F.concat_ws("_", F.col(feed) if isinstance(feed, str) else feed,
                       F.col(currency) if isinstance(currency, str) else currency)


def topic_feed(topic: Column | str) -> Column:
    return F.split_part(F.col(topic) if isinstance(topic, str) else topic, F.lit("_"), F.lit(1))


def topic_currency(topic: Column | str) -> Column:
    """All that follows the first separator: a symbol may contain it itself."""
    return F.regexp_replace(F.col(topic) if isinstance(topic, str) else topic, "^[^_]*_?", "")
