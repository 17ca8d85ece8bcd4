"""Long-running jobs: feed stream -> wide fact table.

``feed_from_kafka`` is the production input (one subscription for all five
topic families, routed and decoded); ``feed_from_files`` replays parquet
files of the long feed schema.  ``consume`` starts either the event-time
query (watermarked windows, final rows only) or the micro-batch parity
query, appending to the partitioned ORC table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..sinks.orc import create_database
from ..sources import kafka as KF
from .event_time import state_partitions, stream_trade_volume
from .microbatch import idempotent_append, start_parity
from .source import read_feed_stream


def feed_from_kafka(spark: SparkSession, bootstrap_servers: str,
                    starting_offsets: str = "latest", **options: str) -> DataFrame:
    """Kafka records of every feed topic as the long feed stream.  Records
    whose value does not decode go to :func:`quarantine_from_kafka`."""
    return KF.as_feed(_decoded(spark, bootstrap_servers, starting_offsets, **options))


def _decoded(spark, bootstrap_servers, starting_offsets, **options) -> DataFrame:
    records = KF.read_kafka(spark, bootstrap_servers, stream=True,
                            starting_offsets=starting_offsets, **options)
    return KF.decode(KF.route(records))


def quarantine_from_kafka(spark: SparkSession, bootstrap_servers: str, starting_offsets: str = "latest",
                          **options: str) -> DataFrame:
    """The records of the same subscription that do not decode."""
    return KF.undecodable(_decoded(spark, bootstrap_servers, starting_offsets, **options))


def write_quarantine(bad: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                     interval_seconds: int = C.MICROBATCH_SECONDS):
    """Keeps undecodable records as Parquet at ``path`` (exactly once, by the file
    sink's log); returns the running query."""
    w = bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{interval_seconds} seconds")
    return w.start()


def feed_from_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return read_feed_stream(spark, path, files_per_trigger)


def consume(spark: SparkSession, feed: DataFrame, *, table: str, checkpoint: str,
            mode: str = "event", step: str = "1 day", delay: str = "1 hour",
            interval_seconds: int = C.MICROBATCH_SECONDS, available_now: bool = False,
            partitions: int | None = None):
    """Start the consumer; returns the running ``StreamingQuery``.

    ``mode='event'``: rows per closed event-time window; ``mode='parity'``:
    one summary per micro-batch stamped with the processing time.
    """
    db = table.split(".")[0] if "." in table else None
    if db:
        create_database(spark, db)
    if mode == "parity":
        return start_parity(feed, spark, checkpoint=checkpoint, table=table,
                            interval_seconds=interval_seconds, available_now=available_now,
                            partitions=partitions)
    rows = stream_trade_volume(feed, step, delay)
    fn = idempotent_append(spark, table=table, log=f"{checkpoint.rstrip('/')}/_batches")
    w = rows.writeStream.outputMode("append").foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{interval_seconds} seconds")
    with state_partitions(spark, partitions):
        q = w.start()
        while q.isActive and q.lastProgress is None:
            q.awaitTermination(1)
    return q
