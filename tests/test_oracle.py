"""Every registered query with oracle SQL matches DuckDB on the sf0.01
tables (row count, column names, multiset of values).  Streaming queries
are exercised in test_streaming.py and by tools/oracle_check.py."""

import os
import sys

import pytest

from feed_help import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from marketlens.plans.registry import REGISTRY  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

KEYS = sorted(k for k in E.oracle_sql() if k in REGISTRY and not k.startswith("stream_") and k != "run_cycle")


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", KEYS)
def test_matches_duckdb(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF01, con, verbose=True)
    assert r["cols_ok"], r
    assert r["types_ok"], r
    assert r["match"], r


def test_every_query_has_a_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 8 and len(df.columns) == 35


STREAM_KEYS = ["stream_trade_volume", "stream_feed_join", "stream_restart", "stream_candles", "stream_dedup", "stream_microbatch",
               "stream_latest_by_symbol", "stream_late_corrections", "run_cycle"]


@pytest.fixture(scope="module")
def con_small():
    from feed_help import SF001
    return duck(SF001)


@pytest.mark.parametrize("name", STREAM_KEYS)
def test_streaming_matches_duckdb(spark, con_small, name):
    from feed_help import SF001
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF001, con_small, verbose=True)
    assert r["cols_ok"] and r["types_ok"] and r["match"], r
