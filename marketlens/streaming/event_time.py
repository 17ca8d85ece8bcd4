"""Event-time streaming: watermark + tumbling windows, append mode.

The same plan functions as in batch are applied to a watermarked stream:
a window is emitted once the watermark passes its end, late rows (older
than the watermark) are dropped and counted by Spark
(``numRowsDroppedByWatermark``), and dedup state is keyed by the ``window``
struct so it is evicted with the window.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..operators import stats as S
from ..operators.candles import candles
from ..plans.trade_volume import trade_volume_onepass


def watermarked(feed: DataFrame, delay: str) -> DataFrame:
    """``us`` (epoch micros) is computed before the watermark so that
    ordering by it does not put a second event-time column into aggregates."""
    return feed.withWatermark("ts", delay)


def feed_stream(feed: DataFrame, name: str, delay: str) -> DataFrame:
    """One feed of the long stream, filtered BEFORE its watermark: the
    watermark then follows that feed's own event time (explicitly, rather
    than depending on the optimizer pushing the filter below it)."""
    return watermarked(feed.where(F.col("feed") == name), delay)


def stream_trade_volume(feed: DataFrame, step: str = "1 day", delay: str = "1 hour",
                        decimals: int | None = None) -> DataFrame:
    """One-pass wide row per (window, symbol) from one read of each
    micro-batch, emitted once the stream's watermark (latest event - delay)
    passes the window."""
    return trade_volume_onepass(feed, step, decimals=decimals, watermark=delay)


def stream_feed_join(feed: DataFrame, step: str = "1 day", delay: str = "1 hour",
                     decimals: int | None = None) -> DataFrame:
    """The fold form on a stream: five feed streams, each with its own
    watermark (as five subscriptions would have), aggregated per window and
    joined on (window, symbol) — stream-stream inner joins of aggregates.
    Under the default ``min`` policy a row is final once every feed has
    passed the window end plus the delay."""
    def bucketed(name):
        return S.with_bucket(feed_stream(feed, name, delay), step)
    frames = [S.price_ohlc(bucketed(C.PRICE))] + [
        S.order_stats(bucketed(n), n, p) for n, p in C.STAT_PREFIX]
    joined = reduce(lambda a, b: a.join(b, list(S.GROUP_KEYS), "inner"), frames)
    from ..plans.trade_volume import _finish
    return _finish(joined, decimals)


def stream_dedup(feed: DataFrame, step: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Distinct book levels per window; emitted on first sight, state evicted
    once the book feeds' watermark passes the window."""
    book = watermarked(feed.where(F.col("feed").isin(*C.BOOK_FEEDS)), delay)
    return S.distinct_levels(S.with_bucket(book, step))


def stream_candles(feed: DataFrame, step: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """PRICE candles per window, emitted once the PRICE watermark passes it."""
    return candles(feed_stream(feed, C.PRICE, delay), step)


@contextmanager
def state_partitions(spark, n: int | None):
    """Scope the number of shuffle (= state store) partitions a streaming
    query is started with.  The value is recorded in the query's checkpoint
    at its first batch, so it only matters when a query starts fresh; it
    should follow the cluster size, not a session default such as 200
    (every micro-batch commits every state partition of every stateful
    operator)."""
    if n is None:
        n = spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def run_to_files(df: DataFrame, out: str, checkpoint: str, *, mode: str = "append",
                 available_now: bool = True, name: str | None = None,
                 partitions: int | None = None) -> StreamingQuery:
    """Run a streaming DataFrame into a parquet file sink (exactly-once via the
    sink's log and the checkpoint) until the available input is consumed."""
    w = df.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w
    with state_partitions(df.sparkSession, partitions):
        q = w.start()
        if available_now:
            q.awaitTermination()
        else:
            while q.isActive and q.lastProgress is None:   # first batch fixes the layout
                q.awaitTermination(1)
    return q


FOLD_EVERY = 50        # batches of changes between two whole versions of a snapshot


def _complete(spark, out: str, kind: str) -> list:
    """(number, file system, path) of the complete parts ``kind``-N of a snapshot, oldest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{out}/{kind}-*/_SUCCESS")) or []
    paths = [s.getPath().getParent() for s in done]
    return sorted(((int(p.getName().rsplit("-", 1)[1]), fs, p) for p in paths), key=lambda x: x[0])


def read_snapshot(spark, out: str, keys: list[str]) -> DataFrame:
    """The snapshot as of its last complete batch: the newest row of every key, from the latest whole version and the
    changes behind it."""
    versions = _complete(spark, out, "version")
    base = versions[-1] if versions else None
    changes = [c for c in _complete(spark, out, "change") if base is None or c[0] > base[0]]
    parts = [spark.read.parquet(p.toString()).withColumn("_batch", F.lit(n)) for n, _, p in ([base] if base else []) + changes]
    if not parts:
        raise FileNotFoundError(f"no complete snapshot at {out}")
    rows = reduce(DataFrame.unionByName, parts)
    values = [c for c in rows.columns if c not in (*keys, "_batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_row"))
    return newest.select(*keys, "_row.*").select(*[c for c in rows.columns if c != "_batch"])


def latest_snapshot(latest: DataFrame, out: str, checkpoint: str, *, keys: list[str] | None = None, fold_every: int = FOLD_EVERY,
                    available_now: bool = True, partitions: int | None = None) -> StreamingQuery:
    """Keep the latest value per key as a table at ``out``.

    The aggregate's state holds one row per key (bounded by the number of
    keys, so no watermark is needed).  In update mode a batch brings the keys it touched, and only those are
    written, as the batch's changes; readers (:func:`read_snapshot`) lay them over the last whole version.
    Every ``fold_every`` batches the two become a new version, so a reader opens a bounded number of
    parts.  Each part is complete or ignored, a replayed batch rewrites its own, and the
    version before the last stays for readers that have begun.
    """
    spark = latest.sparkSession
    keys = keys or ["currency", "feed"]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/change-{batch_id:012d}")
        if (batch_id + 1) % fold_every == 0:
            read_snapshot(spark, out, keys).write.mode("overwrite").parquet(f"{out}/version-{batch_id:012d}")
            for _, fs, p in _complete(spark, out, "version")[:-2]:
                fs.delete(p, True)
            for n, fs, p in _complete(spark, out, "change"):
                if n <= batch_id - fold_every:
                    fs.delete(p, True)
    w = latest.writeStream.outputMode("update").foreachBatch(write) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    with state_partitions(latest.sparkSession, partitions):
        q = w.start()
        if available_now:
            q.awaitTermination()
        else:
            while q.isActive and q.lastProgress is None:
                q.awaitTermination(1)
    return q
