"""Registered queries: Structured Streaming.

Each query replays the feed table through the file source (one parquet
file per UTC day, written by one job, read in time order), runs a real streaming query to the end of
the available input, and returns what the sink holds.  Event-time oracles
keep the windows that the final watermark (latest event - delay) closed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path
from ..sinks import orc as O
from ..sources.fixtures import feed_table
from ..streaming import event_time as E
from ..streaming.cycle import run_cycle
from ..streaming.jobs import consume
from ..streaming.late import correct_windows, split_late
from ..streaming.microbatch import start_parity
from ..streaming.source import read_feed_stream, write_time_slices
from . import sqlgen as Q
from .registry import register, rounded

_INPUTS: dict[tuple[str, str], str] = {}
DELAY = "1 hour"
CANDLE_STEP, CANDLE_DELAY = "1 hour", "10 minutes"


def stream_input(spark, sf_dir: str) -> str:
    """Day slices of the feed table (written once per application)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INPUTS:
        path = scratch_path(spark, "stream_input")
        write_time_slices(feed_table(spark, sf_dir), path)
        _INPUTS[key] = path
    return _INPUTS[key]


def _run(spark, df, name):
    out, ckpt = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ckpt")
    E.run_to_files(df, out, ckpt)
    return spark.read.schema(df.schema).parquet(out)


def watermark_sql(delay: str, feeds=C.FEEDS) -> str:
    """Final watermark of per-feed watermarks under the ``min`` policy:
    min over feeds of (latest event instant at millisecond precision) - delay."""
    names = ", ".join(f"'{n}'" for n in feeds)
    return (f"(SELECT min(mx) FROM (SELECT date_trunc('millisecond', max(ts)) AS mx FROM feed "
            f"WHERE feed IN ({names}) GROUP BY feed)) - INTERVAL {delay}")


def stream_watermark_sql(delay: str) -> str:
    """Final watermark of one stream: latest event instant (millisecond
    precision) minus the delay."""
    return f"(SELECT date_trunc('millisecond', max(ts)) FROM feed) - INTERVAL {delay}"


def _closed_tv_sql(step="1 day", delay=DELAY, per_feed=False) -> str:
    wm = watermark_sql(delay) if per_feed else stream_watermark_sql(delay)
    return f"""WITH {Q.trade_volume_cte(step)}
SELECT * FROM tv WHERE current_time + INTERVAL {step} <= {wm}"""


@register("stream_trade_volume", _closed_tv_sql())
def q_stream_trade_volume(spark, sf_dir):
    """One-pass wide row on a watermarked stream (day windows, 1 h delay)."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    return rounded(_run(spark, E.stream_trade_volume(s, "1 day", DELAY), "stream_tv"))


@register("stream_feed_join", _closed_tv_sql(per_feed=True))
def q_stream_feed_join(spark, sf_dir):
    """Five windowed feed summaries joined stream-to-stream on (window, symbol)."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    return rounded(_run(spark, E.stream_feed_join(s, "1 day", DELAY), "stream_join"))


@register("stream_dedup", f"""WITH {Q.feed_sql()}
SELECT DISTINCT {Q.bucket_sql('1 day')} AS current_time, currency, feed, cost, quantity
FROM feed WHERE feed IN ('BID', 'ASK')""")
def q_stream_dedup(spark, sf_dir):
    """Distinct book levels per day window on a watermarked stream."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    d = _run(spark, E.stream_dedup(s, "1 day", DELAY), "stream_dedup")
    return d.select(F.col("window.start").cast("timestamp_ntz").alias("current_time"),
                    "currency", "feed", "cost", "quantity")


@register("stream_candles", f"""WITH {Q.feed_sql()},
c AS (SELECT currency, {', '.join(Q.ohlc_sql())}, count(*) AS ticks,
             {Q.bucket_sql(CANDLE_STEP)} AS current_time
      FROM feed WHERE feed = 'PRICE' GROUP BY {Q.bucket_sql(CANDLE_STEP)}, currency)
SELECT * FROM c
WHERE current_time + INTERVAL {CANDLE_STEP} <= {watermark_sql(CANDLE_DELAY, [C.PRICE])}""")
def q_stream_candles(spark, sf_dir):
    """Hourly PRICE candles emitted once the watermark closes them."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    c = _run(spark, E.stream_candles(s, CANDLE_STEP, CANDLE_DELAY), "stream_candles")
    from ..operators.stats import finish
    return finish(c, Q.R)


def _parity_sql() -> str:
    return f"""WITH {Q.trade_volume_cte('1 day')},
closes AS (SELECT date_trunc('day', ts) AS day, max(ts) AS now FROM feed GROUP BY 1)
SELECT tv.* EXCLUDE (current_time, current_day), closes.now AS current_time,
       CAST(closes.now AS DATE) AS current_day
FROM tv JOIN closes ON tv.current_time = closes.day"""


@register("stream_microbatch", _parity_sql())
def q_stream_microbatch(spark, sf_dir):
    """Parity mode: one summary per micro-batch (here one file = one UTC day
    per batch), stamped with the batch close instant, appended to ORC by an
    idempotent ``foreachBatch``."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=1)
    path, ckpt = scratch_path(spark, "parity_tv"), scratch_path(spark, "parity_ckpt")
    q = start_parity(s, spark, checkpoint=ckpt, path=path, stamp="event", available_now=True)
    q.awaitTermination()
    return rounded(O.read_partitioned(spark, path))


@register("stream_restart", _closed_tv_sql())
def q_stream_restart(spark, sf_dir):
    """The one-pass stream run on the first half (in event time) of the
    input, stopped, then restarted from its checkpoint after the second half
    arrived: no row lost, none repeated."""
    feed = feed_table(spark, sf_dir)
    mid = feed.agg(F.percentile_approx("us", 0.5).alias("m")).first()["m"]
    src = scratch_path(spark, "restart_in")
    out, ckpt = scratch_path(spark, "restart_out"), scratch_path(spark, "restart_ckpt")
    halves = [feed.where(F.col("us") < mid), feed.where(F.col("us") >= mid)] if mid is not None else [feed]
    for half in halves:
        write_time_slices(half, src)            # new files arrive ...
        s = read_feed_stream(spark, src, files_per_trigger=5)
        E.run_to_files(E.stream_trade_volume(s, "1 day", DELAY), out, ckpt)   # ... query restarts
    return rounded(spark.read.parquet(out))


@register("run_cycle", _closed_tv_sql())
def q_run_cycle(spark, sf_dir):
    """A bounded streaming cycle (consume what is available, stop) appending
    closed windows to the fact table, followed by in-place compaction."""
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    loc = scratch_path(spark, "cycle")
    O.create_database(spark, C.DATABASE, f"{loc}/{C.DATABASE}.db")
    table = f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}_cycle_{loc.rsplit('-', 1)[-1]}"
    out = run_cycle(spark, s, table=table, checkpoint=f"{loc}/_ckpt", available_now=True)
    return rounded(out)


@register("stream_late_corrections", _closed_tv_sql())
def q_stream_late_corrections(spark, sf_dir):
    """A tenth of the first half of the feed arrives after the second half: late rows go to a side table, on-time ones through the
    event-time query, and the windows concerned are corrected in the fact table."""
    feed = feed_table(spark, sf_dir)
    mid = feed.agg(F.percentile_approx("us", 0.5).alias("m")).first()["m"]
    tardy = (F.col("us") < mid) & (F.pmod(F.xxhash64("seq"), F.lit(10)) == 0) if mid is not None else F.lit(False)
    loc = scratch_path(spark, "late")
    O.create_database(spark, C.DATABASE, f"{loc}/{C.DATABASE}.db")
    table = f"{C.DATABASE}.{C.TRADE_VOLUME_TABLE}_late_{loc.rsplit('-', 1)[-1]}"
    places = {"archive": f"{loc}/archive", "late": f"{loc}/side"}
    for part in (feed.where(F.coalesce(~tardy, F.lit(True))), feed.where(tardy)):
        write_time_slices(part, f"{loc}/in")
        split_late(read_feed_stream(spark, f"{loc}/in", files_per_trigger=5), checkpoint=f"{loc}/_split", step="1 day", delay=DELAY,
                   available_now=True, **places).awaitTermination()
    consume(spark, read_feed_stream(spark, places["archive"], files_per_trigger=5), table=table, checkpoint=f"{loc}/_main", step="1 day",
            delay=DELAY, available_now=True).awaitTermination()
    end = spark.read.parquet(places["archive"]).agg(F.max("ts").alias("m")).select(F.col("m") - F.expr(f"INTERVAL {DELAY}")).first()[0]
    if end is not None:
        correct_windows(spark, table=table, closed_before=end, step="1 day", **places)
    return rounded(spark.table(table))


@register("stream_latest_by_symbol", f"""WITH {Q.feed_sql()}
SELECT currency, feed, last(cost ORDER BY us, seq) AS cost, last(quantity ORDER BY us, seq) AS quantity,
       last(ts ORDER BY us, seq) AS ts, last(seq ORDER BY us, seq) AS seq
FROM feed GROUP BY currency, feed""")
def q_stream_latest_by_symbol(spark, sf_dir):
    """Latest value of every feed per symbol maintained by a streaming aggregate; every batch writes the
    keys it changed into a snapshot table."""
    from ..operators.feeds import latest_by_key
    s = read_feed_stream(spark, stream_input(spark, sf_dir), files_per_trigger=5)
    out = scratch_path(spark, "latest_snapshot")
    E.latest_snapshot(latest_by_key(s), out, scratch_path(spark, "latest_ckpt"))
    snap = E.read_snapshot(spark, out, ["currency", "feed"])
    return snap.select("currency", "feed", "cost", "quantity",
                       F.col("ts").cast("timestamp_ntz").alias("ts"), "seq")
