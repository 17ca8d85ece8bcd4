"""The ``trade_volume`` fact table: partitioned ORC append, database
creation, and compaction into files of a target size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialise
from .commit import Files, Publication, StagedAppend, location_of, staging

FILES_PER_ROUND = 20_000       # files that one pass of a compaction names
SMALL = 0.75                   # share of the target size below which a file is small


def create_database(spark: SparkSession, name: str = C.DATABASE, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _last(df: DataFrame, partition_cols) -> DataFrame:
    """Partition columns last, in table order."""
    return df.select(*[c for c in df.columns if c not in partition_cols], *partition_cols)


def _partitioned_layout(df: DataFrame, partition_cols=C.PARTITION_COLUMNS,
                        tasks: int | None = None) -> DataFrame:
    """Partition columns last, in table order; rows clustered by partition so
    each task writes one file per partition it holds.  Without ``tasks`` the
    write is rebalanced by bytes: small partitions meet in one task and a hot partition is
    split over several.  A table-sized write of many small partitions passes ``tasks`` so that
    they are written in parallel rather than by a few tasks in sequence."""
    out = _last(df, partition_cols)
    return out.repartition(tasks, *partition_cols) if tasks else out.hint("rebalance", *partition_cols)


def _create(df: DataFrame, table: str, path: str | None, partition_cols=C.PARTITION_COLUMNS, fmt: str = "orc") -> None:
    """The empty table of a DataFrame's columns."""
    empty = df.sparkSession.createDataFrame([], _last(df, partition_cols).schema)
    w = empty.write.mode("append").format(fmt).partitionBy(*partition_cols)
    (w.option("path", path) if path else w).saveAsTable(table)


def append_partitioned(df: DataFrame, *, table: str | None = None, path: str | None = None,
                       partition_cols=C.PARTITION_COLUMNS, fmt: str = "orc",
                       tasks: int | None = None) -> None:
    """Append a batch to the partitioned table.

    With ``table`` the write goes through the catalog (``saveAsTable``;
    managed unless ``path`` is also given); with only ``path`` it writes the
    files directly.  A caller that may come again with the same rows uses :func:`staged_append`.
    """
    w = _partitioned_layout(df, partition_cols, tasks).write.mode("append").format(fmt) \
        .partitionBy(*partition_cols)
    if table:
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("table or path is required")


def staged_append(spark: SparkSession, log: str, *, table: str | None = None, path: str | None = None,
                  partition_cols=C.PARTITION_COLUMNS, fmt: str = "orc") -> StagedAppend:
    """Exactly-once appends of numbered batches (:mod:`.commit`)."""
    def write(df: DataFrame, staged: str) -> None:
        _partitioned_layout(df, partition_cols).write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(staged)

    return StagedAppend(spark, log, write, table=table, path=path,
                        create=lambda df, t, p: _create(df, t, p, partition_cols, fmt))


# ---------------------------------------------------------------------------
# S10 compaction
# ---------------------------------------------------------------------------

def small_files(spark: SparkSession, root: str, target_bytes: int, fmt: str = "orc") -> DataFrame:
    """(path, file, folder, size) of the files to be packed: those below ``SMALL`` of the target, where a partition
    has two or more.  Only names and sizes are listed, no file is opened."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(root)
              .select("path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
              .withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")))
    small = listed.where(F.col("size") < SMALL * target_bytes)
    several = small.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("folder").alias("of"))
    return small.join(several, F.col("folder") == F.col("of"), "left_semi")


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """Adds ``bin``: the files of a partition in order of size, put into bins of about ``target_bytes``.  A bin is
    one output file; bins of a partition hold at least half of the target, but for a single one."""
    order = Window.partitionBy("folder").orderBy(F.desc("size"), "path")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("size").over(Window.partitionBy("folder"))
    # a remainder of less than half a bin is spread over the others
    bins = F.greatest(F.round(whole / target_bytes), F.lit(1.0))
    return files.withColumn("bin", F.least(F.floor(before * bins / whole), bins - 1).cast("int"))


def size_histogram(spark: SparkSession, root: str, fmt: str = "orc") -> DataFrame:
    """(folder, log2_size, files, bytes): how large the files of every partition are."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(root)
              .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("_metadata.file_size").alias("size")))
    return (listed.groupBy("folder", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("log2_size"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")))


def recover_compaction(spark: SparkSession, table: str) -> int:
    """Finishes the compactions of a table that were planned but not carried out; returns how many."""
    log = f"{location_of(spark, table)}/_staged/compactions"
    files = Files(spark, log)
    open_ = [n.removesuffix(".manifest") for n in files.names(log) if n.endswith(".manifest")]
    for name in open_:
        Publication(spark, log, name).publish(table)
    return len(open_)


def compact(spark: SparkSession, table: str, partition_cols=C.PARTITION_COLUMNS,
            tasks: int | None = None, target_bytes: int = 256 << 20, fmt: str = "orc") -> DataFrame:
    """Pack the small files of every partition into files of about ``target_bytes``.

    Keeps every row (no deduplication).  Files that are large enough, and small ones that are alone in their partition, are not
    read or written.  Bins are dealt to tasks so that no two bins of a partition meet: a
    partition with most of the table's bytes is written by as many tasks as it has bins, many
    small partitions share a task.  New files are staged and published together with the removal of
    the old ones (:mod:`.commit`); a compaction that was interrupted is finished by the next one.
    Like the append it replaces, it is meant to run while no reader is in the middle of a scan.
    """
    recover_compaction(spark, table)
    root = location_of(spark, table)
    log = f"{root}/_staged/compactions"
    plan = materialise(packed(small_files(spark, root, target_bytes, fmt), target_bytes), "compaction-files")
    total = plan.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.max("bin").alias("bin")).first()
    if not total["n"]:
        return spark.table(table)
    rounds = -(-total["n"] // FILES_PER_ROUND)
    n = max(tasks or spark.sparkContext.defaultParallelism, -(-total["bytes"] // target_bytes), total["bin"] + 1)
    bins = plan.select("folder", "bin").distinct().withColumn(
        "task", (F.row_number().over(Window.orderBy("folder", "bin")) % n).cast("int"))      # one small row per output file
    bins = bins.select(F.col("folder").alias("of"), F.col("bin").alias("nth"), "task", F.pmod(F.xxhash64("folder"), F.lit(rounds)).alias("round"))
    plan = materialise(plan.join(bins, (F.col("folder") == F.col("of")) & (F.col("bin") == F.col("nth"))).select("path", "file", "task", "round"), "compaction-plan")
    schema = spark.table(table).schema
    for r in range(rounds):
        mine = plan.where(F.col("round") == r)
        paths = [x["path"] for x in mine.select("path").collect()]
        if not paths:
            continue
        unit = Publication(spark, log, f"compact-{uuid.uuid4().hex[:12]}")
        staged = f"{staging(root, log)}/{unit.name}"
        rows = spark.read.format(fmt).schema(schema).option("basePath", root).load(paths)
        to = F.broadcast(mine.select(F.col("file").alias("_of"), F.col("task").alias("_task")))
        (rows.select("*", F.col("_metadata.file_path").alias("_file")).join(to, F.col("_file") == F.col("_of"))
         .repartitionById(n, F.col("_task")).select(*rows.columns)
         .write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(staged))
        unit.plan(root, staged, unit.name, replaced=paths)
        unit.publish(table)
    return spark.table(table)


def file_count(spark: SparkSession, table_or_df) -> int:
    """Number of data files behind a table or DataFrame."""
    df = spark.table(table_or_df) if isinstance(table_or_df, str) else table_or_df
    return len(df.inputFiles())


def read_partitioned(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    return spark.read.format(fmt).load(path)


def hash_slices(df: DataFrame, n: int, col: str = "current_day") -> list[DataFrame]:
    """Split rows into ``n`` disjoint slices by a hash of ``col`` (for writing a
    table in several appends)."""
    h = F.pmod(F.hash(F.col(col)), F.lit(n))
    return [df.where(h == i) for i in range(n)]
