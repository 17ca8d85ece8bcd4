"""Late rows are kept, and the windows they belong to are corrected.

A windowed aggregate drops rows whose window its watermark has closed.  Here the feed first passes a
split (:func:`split_late`): rows whose window is still open go to an archive, rows behind the
watermark to a side table, each exactly once.  The event-time query reads the archive as its stream; its own watermark is
never ahead of the split's, so it drops nothing, and every row is in one of the two tables.

:func:`correct_windows` computes the closed windows that late rows belong to again, from both tables, and
replaces their rows in the fact table, by staged files and one manifest (:mod:`..sinks.commit`).  It can be repeated
at any time: a window's corrected row depends on the two tables only.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .. import config as C
from ..functions.timegrid import interval
from ..plans.trade_volume import trade_volume_onepass
from ..schemas import FEED_SCHEMA
from ..session import materialise
from ..sinks.commit import Files, Publication, location_of, staging
from ..sinks.orc import staged_append

DAY, END = "day", "_window_end"
WINDOWS_BROADCAST = 200_000


class WatermarkLog:
    """The split's watermark before every batch (epoch micros), one small file per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark, path), path.rstrip("/")

    def before(self, batch_id: int) -> int | None:
        name = f"{self.path}/after-{batch_id - 1:012d}"
        text = self.files.read(name) if batch_id and self.files.exists(name) else ""
        return int(text) if text else None

    def after(self, batch_id: int, watermark: int | None) -> None:
        self.files.mkdirs(self.path)
        self.files.write(f"{self.path}/after-{batch_id:012d}", "" if watermark is None else str(watermark))


def _micros(spark: SparkSession, length: str) -> int:
    epoch = F.to_timestamp(F.lit("1970-01-01 00:00:00"))
    return spark.range(1).select(F.unix_micros(epoch + interval(length)) - F.unix_micros(epoch)).first()[0]


def split_late(stream: DataFrame, *, archive: str, late: str, checkpoint: str, step: str = "1 day", delay: str = "1 hour",
               available_now: bool = False, interval_seconds: int = C.MICROBATCH_SECONDS):
    """Start the split of a feed stream; returns the running query.  A row is late if its ``step`` window ended at
    or before the watermark, the latest event time of all earlier batches minus ``delay``; rows without an
    instant are never late."""
    spark = stream.sparkSession
    base = checkpoint.rstrip("/")
    marks = WatermarkLog(spark, f"{base}/_watermark")
    sinks = [staged_append(spark, f"{base}/_{name}", path=path, partition_cols=(DAY,), fmt="parquet")
             for name, path in (("archive", archive), ("late", late))]
    delay_us, step_us = _micros(spark, delay), _micros(spark, step)
    window_end = (F.floor(F.unix_micros("ts") / step_us) + 1) * step_us      # null without an instant
    columns = [f.name for f in FEED_SCHEMA.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = marks.before(batch_id)
        batch = batch.select(*columns).withColumn(DAY, F.col("ts").cast("date")).withColumn(END, window_end).persist()
        try:
            behind = F.coalesce(F.col(END) <= mark, F.lit(False)) if mark is not None else F.lit(False)
            sinks[0].append(batch.where(~behind).drop(END), batch_id)
            sinks[1].append(batch.where(behind).drop(END), batch_id)
            newest = batch.agg(F.max("us")).first()[0]
        finally:
            batch.unpersist()
        seen = [m for m in (mark, None if newest is None else newest - delay_us) if m is not None]
        marks.after(batch_id, max(seen, default=None))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", base)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{interval_seconds} seconds")
    return w.start()


def _feed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an archive or side table, in the feed's schema."""
    if not Files(spark, path).data_files(path):
        return spark.createDataFrame([], FEED_SCHEMA)
    stored = StructType([*FEED_SCHEMA.fields, StructField(DAY, DateType())])
    return spark.read.schema(stored).parquet(path).drop(DAY)


def late_windows(spark: SparkSession, late: str, step: str, closed_before: dt.datetime) -> DataFrame:
    """(start, symbol): the windows of the late rows that have ended by ``closed_before``."""
    w = F.window(F.col("ts"), step)
    return (_feed(spark, late).where("ts IS NOT NULL").select(w["start"].alias("start"), w["end"].alias("end"), F.col("currency").alias("symbol"))
            .where(F.col("end") <= F.lit(closed_before)).select("start", "symbol").distinct())


def correct_windows(spark: SparkSession, *, archive: str, late: str, table: str, closed_before: dt.datetime, step: str = "1 day",
                    partition_cols=C.PARTITION_COLUMNS, fmt: str = "orc") -> int:
    """Replace the rows of all closed windows that have late rows; returns the number of windows.

    ``closed_before`` is the watermark up to which the event-time query has emitted its windows."""
    windows = materialise(late_windows(spark, late, step, closed_before), "late-windows")
    n = windows.count()
    if not n:
        return 0

    def few(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= WINDOWS_BROADCAST else df

    feed = _feed(spark, archive).unionByName(_feed(spark, late)).withColumn("_start", F.window(F.col("ts"), step)["start"])
    mine = (F.col("_start") == F.col("start")) & F.col("currency").eqNullSafe(F.col("symbol"))
    rows = feed.join(few(windows), mine, "left_semi").drop("_start")
    corrected = trade_volume_onepass(rows, step)
    stored = spark.table(table)
    flavour = stored.schema["current_time"].dataType
    windows = windows.select(F.col("start").cast(flavour).alias("start"), "symbol")
    touched = windows.select(*[F.col("start").cast("date").alias("_day"), F.col("symbol").alias("_symbol")]).distinct()
    by = {"current_day": "_day", "currency": "_symbol"}
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(by[c])) for c in partition_cols])
    old = stored.select("*", F.col("_metadata.file_path").alias("_file")).join(few(touched), same, "left_semi")
    replaced = [unquote(r["_file"]) for r in old.select("_file").distinct().collect()]
    kept = old.drop("_file").join(few(windows), (F.col("current_time") == F.col("start")) & F.col("currency").eqNullSafe(F.col("symbol")), "left_anti")
    root = location_of(spark, table)
    unit = Publication(spark, f"{root}/_staged/compactions", f"late-{uuid.uuid4().hex[:12]}")
    staged = f"{staging(root, unit.log)}/{unit.name}"
    out = kept.unionByName(corrected.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]))
    (out.hint("rebalance", *partition_cols).write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(staged))
    unit.plan(root, staged, unit.name, replaced=replaced)
    unit.publish(table)
    return n
