"""Streaming inputs.

In production the stream is the Kafka subscription of
:mod:`marketlens.sources.kafka`.  Tests and benchmarks replay a feed table
through Spark's file source: one job writes the rows as one parquet file per
time slice, all slices in parallel, and the files get modification times in
slice order, which is the order in which the file source reads them.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_SCHEMA


def _files(spark: SparkSession, path: str) -> dict[str, object]:
    """Data files below ``path`` (none if it does not exist)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, object] = {}
    if fs.exists(root):
        it = fs.listFiles(root, True)
        while it.hasNext():
            p = it.next().getPath()
            if p.getName().startswith("part-"):
                out[p.toString()] = (fs, p)
    return out


def write_time_slices(feed: DataFrame, path: str, slice_seconds: int = 86400) -> int:
    """Write ``feed`` as time slices, one file each, in ONE job over one scan;
    returns the number of slices.  Only file metadata is touched per slice:
    modification times put the new files behind older ones, oldest slice
    first."""
    spark = feed.sparkSession
    rows = feed.select(*[f.name for f in FEED_SCHEMA.fields]).withColumn(
        "_slice", F.floor(F.col("us") / (slice_seconds * 1_000_000)))
    before = _files(spark, path)
    rows.repartition(spark.sparkContext.defaultParallelism, "_slice") \
        .write.mode("append").partitionBy("_slice").parquet(path)
    new = {k: v for k, v in _files(spark, path).items() if k not in before}

    def slice_of(name: str) -> tuple[int, int]:
        m = re.search(r"/_slice=(-?\d+)/", name)       # rows without an instant come last
        return (0, int(m[1])) if m else (1, 0)
    ordered = sorted(new, key=slice_of)
    first = int(time.time() * 1000) - len(ordered)
    for i, name in enumerate(ordered):
        fs, p = new[name]
        fs.setTimes(p, first + i, -1)
    return len(ordered)


def read_feed_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Replay the slices as a stream with the declared feed schema."""
    return (spark.readStream.schema(FEED_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true")
            .parquet(path))
