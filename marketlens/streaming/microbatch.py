"""Micro-batch parity mode and idempotent batch sinks.

Parity mode reproduces the reference's semantics — every micro-batch is
summarised as a whole (one row per symbol present in all five feeds),
stamped with the batch's instant and appended to the partitioned fact table
— but as one Structured Streaming query with ``foreachBatch``.

``foreachBatch`` is at-least-once: after a failure the last batch is
replayed with the same id.  Batches are appended in two phases (:mod:`..sinks.commit`), so a replayed
batch is skipped, finished, or written anew, wherever the failure struck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..plans.trade_volume import trade_volume_batch
from ..sinks.orc import staged_append


def idempotent_append(spark: SparkSession, *, table: str | None = None, path: str | None = None,
                      log: str, transform=None):
    """``foreachBatch`` function appending each batch exactly once to the table."""
    sink = staged_append(spark, log, table=table, path=path)

    def write(batch: DataFrame, batch_id: int) -> None:
        unit = sink.unit(batch_id)
        if unit.committed or unit.planned:          # what the earlier attempt wrote counts, not these rows
            sink.append(None, batch_id)
            return
        batch = batch.persist()          # read the batch once for stamp + write
        try:
            sink.append(transform(batch, batch_id) if transform else batch, batch_id)
        finally:
            batch.unpersist()
    return write


def parity_transform(stamp: str = "processing"):
    """Per-batch summary.  ``stamp='processing'`` stamps the processing
    time (reference behaviour); ``'event'`` stamps the latest event instant
    of the batch, which makes replays and tests deterministic."""
    def transform(batch: DataFrame, batch_id: int):
        if stamp == "event":
            now = batch.agg(F.max(F.col("ts").cast("timestamp_ntz")).alias("m")).first()["m"]
            if now is None:                 # empty batch: nothing to write
                return None
        else:
            now = F.current_timestamp()
        return trade_volume_batch(batch, now)
    return transform


def start_parity(stream: DataFrame, spark: SparkSession, *, checkpoint: str,
                 table: str | None = None, path: str | None = None, stamp: str = "processing",
                 interval_seconds: int = C.MICROBATCH_SECONDS, available_now: bool = False,
                 partitions: int | None = None):
    """Start the parity-mode query: one summary per micro-batch, appended to
    the fact table.  ``available_now`` consumes what is there and stops."""
    fn = idempotent_append(spark, table=table, path=path, log=f"{checkpoint.rstrip('/')}/_batches",
                           transform=parity_transform(stamp))
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{interval_seconds} seconds")
    from .event_time import state_partitions
    with state_partitions(spark, partitions):
        q = w.start()
        while q.isActive and q.lastProgress is None:
            q.awaitTermination(1)
    return q
