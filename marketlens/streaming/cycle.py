"""Bounded run cycles: stream for a while, stop, compact, repeat.

The reference runs its streaming job under a scheduler timeout and then
compacts the table with a separate SQL job.  Here both steps are one
function in one Spark application; a timeout is a normal stop, and the
checkpoint makes the next cycle resume exactly where this one stopped.

:func:`supervise` repeats the cycle until it is told to stop.  Where it is stands in the shared folder
(:class:`CycleLog`), so a supervisor that starts after a crash goes on with the step that was interrupted: a cycle that had
stopped its stream but not compacted is compacted first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..sinks.commit import Files
from ..sinks.orc import compact, create_database, recover_compaction
from .event_time import state_partitions, stream_trade_volume
from .microbatch import idempotent_append

# --- fixed values: steps of a cycle, in order ----------------------------------
STEPS = ("run", "stopping", "compacting")


class CycleLog:
    """The steps that were begun, one empty file each (cycle number and step); the last is where things stand."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark, path), path.rstrip("/")

    def steps(self) -> list[tuple[int, str]]:
        found = [n.split("-", 1) for n in self.files.names(self.path) if n.endswith(STEPS)]
        return sorted(((int(a), b) for a, b in found), key=lambda x: (x[0], STEPS.index(x[1])))

    def now(self) -> tuple[int, str]:
        done = self.steps()
        return done[-1] if done else (0, STEPS[0])

    def begin(self, cycle: int, step: str) -> None:
        self.files.mkdirs(self.path)
        if (cycle, step) not in self.steps():
            self.files.write(f"{self.path}/{cycle:08d}-{step}")
        for old, name in self.steps()[:-8]:          # a few steps of history are enough
            self.files.delete(f"{self.path}/{old:08d}-{name}")


def run_stream(spark: SparkSession, stream: DataFrame, *, table: str, checkpoint: str, step: str = "1 day", delay: str = "1 hour",
               minutes: float | None = None, available_now: bool = False, interval_seconds: float = C.MICROBATCH_SECONDS,
               partitions: int | None = None, stop: Callable[[], bool] | None = None) -> None:
    """Append closed event-time windows of the wide row to ``table`` until
    ``minutes`` pass (or, with ``available_now``, the input is consumed, or ``stop`` says so), then stop."""
    rows = stream_trade_volume(stream, step, delay)
    fn = idempotent_append(spark, table=table, log=f"{checkpoint.rstrip('/')}/_batches")
    w = rows.writeStream.outputMode("append").foreachBatch(fn) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{interval_seconds} seconds")
    with state_partitions(spark, partitions):
        q = w.start()
        while q.isActive and q.lastProgress is None:
            q.awaitTermination(1)
    try:
        if available_now:
            q.awaitTermination()
        else:
            left = None if minutes is None else minutes * 60
            while q.isActive and (left is None or left > 0) and not (stop and stop()):
                q.awaitTermination(1 if left is None else min(1.0, left))
                left = None if left is None else left - 1
    finally:
        q.stop()
    if q.exception() is not None:
        raise q.exception()


def run_cycle(spark: SparkSession, stream: DataFrame, *, table: str, checkpoint: str,
              step: str = "1 day", delay: str = "1 hour",
              minutes: float | None = C.RUN_CYCLE_MINUTES, available_now: bool = False,
              interval_seconds: float = C.MICROBATCH_SECONDS,
              partitions: int | None = None) -> DataFrame:
    """One cycle: a bounded run (:func:`run_stream`), then compaction of the table in place."""
    if "." in table:
        create_database(spark, table.split(".")[0])
    run_stream(spark, stream, table=table, checkpoint=checkpoint, step=step, delay=delay, minutes=minutes,
               available_now=available_now, interval_seconds=interval_seconds, partitions=partitions)
    if not spark.catalog.tableExists(table):      # nothing closed yet
        return spark.createDataFrame([], stream_trade_volume(stream, step, delay).schema)
    return compact(spark, table)


def supervise(spark: SparkSession, make_stream: Callable[[], DataFrame], *, table: str, checkpoint: str, step: str = "1 day",
              delay: str = "1 hour", minutes: float = C.RUN_CYCLE_MINUTES, interval_seconds: float = C.MICROBATCH_SECONDS,
              cycles: int | None = None, stop_file: str | None = None, partitions: int | None = None, target_bytes: int = 256 << 20) -> int:
    """Repeat timed cycles until ``cycles`` are done or ``stop_file`` exists; returns the number of the next cycle.

    ``make_stream`` gives the input of each run; the stream resumes from ``checkpoint``."""
    if "." in table:
        create_database(spark, table.split(".")[0])
    log = CycleLog(spark, f"{checkpoint.rstrip('/')}/_cycles")

    def told_to_stop() -> bool:
        return stop_file is not None and Files(spark, stop_file).exists(stop_file)

    cycle, at = log.now()
    done = 0
    while cycles is None or done < cycles:
        if at == STEPS[0]:
            if told_to_stop():
                break
            log.begin(cycle, STEPS[0])
            if spark.catalog.tableExists(table):
                recover_compaction(spark, table)
            run_stream(spark, make_stream(), table=table, checkpoint=f"{checkpoint.rstrip('/')}/stream", step=step, delay=delay,
                       minutes=minutes, interval_seconds=interval_seconds, partitions=partitions, stop=told_to_stop)
            log.begin(cycle, STEPS[1])
        log.begin(cycle, STEPS[2])
        if spark.catalog.tableExists(table):
            compact(spark, table, target_bytes=target_bytes)
        cycle, at = cycle + 1, STEPS[0]
        log.begin(cycle, STEPS[0])
        done += 1
    return cycle
