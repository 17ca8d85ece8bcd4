"""Exactly-once appends and compaction under crashes, and size-targeted packing."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from marketlens import config as C
from marketlens.session import scratch_path
from marketlens.sinks import commit as K
from marketlens.sinks import orc as O
from marketlens.streaming.microbatch import idempotent_append


class Crash(RuntimeError):
    pass


def rows(spark, lo, n, day="2024-01-01"):
    return spark.range(lo, lo + n).select(F.col("id").alias("v"), F.lit(day).cast("date").alias("current_day"),
                                          F.concat(F.lit("S/"), (F.col("id") % 3).cast("string")).alias("currency"))


def values(df):
    return sorted(r.v for r in df.collect())


def crashing(monkeypatch, method, nth):
    """Lets the nth call of a file operation fail; returns a switch that mends it."""
    real, calls = getattr(K.Files, method), [0]

    def fail(self, *a):
        calls[0] += 1
        if calls[0] == nth:
            raise Crash(method)
        return real(self, *a)

    monkeypatch.setattr(K.Files, method, fail)
    return lambda: monkeypatch.setattr(K.Files, method, real)


@pytest.mark.parametrize("use_table", [False, True])
@pytest.mark.parametrize("method,nth", [("data_files", 1), ("mkdirs", 1), ("rename", 1), ("rename", 2), ("rename", 3), ("write", 1), ("write", 2), ("delete", 1), ("delete", 2)])
def test_crash_anywhere_between_append_and_log(spark, monkeypatch, method, nth, use_table):
    log = scratch_path(spark, "t_commit_log")
    target = {"path": scratch_path(spark, "t_commit")}
    if use_table:
        O.create_database(spark, C.DATABASE)
        target = {"table": f"{C.DATABASE}.c_{uuid.uuid4().hex[:8]}"}
    read = lambda: spark.table(target["table"]) if use_table else O.read_partitioned(spark, target["path"])
    idempotent_append(spark, log=log, **target)(rows(spark, 0, 10), 0)
    mend = crashing(monkeypatch, method, nth)
    with pytest.raises(Crash):
        idempotent_append(spark, log=log, **target)(rows(spark, 10, 10), 1)
    mend()
    # a new attempt, in a new process, with the same batch id
    idempotent_append(spark, log=log, **target)(rows(spark, 10, 10), 1)
    assert values(read()) == list(range(20))
    idempotent_append(spark, log=log, **target)(rows(spark, 10, 10), 1)
    idempotent_append(spark, log=log, **target)(rows(spark, 20, 5, "2024-01-02"), 2)
    assert values(read()) == list(range(25))


def test_replay_after_manifest_ignores_new_rows(spark, monkeypatch):
    log, path = scratch_path(spark, "t_commit_log"), scratch_path(spark, "t_commit")
    mend = crashing(monkeypatch, "rename", 2)          # the manifest is there, no file moved
    with pytest.raises(Crash):
        idempotent_append(spark, log=log, path=path)(rows(spark, 0, 6), 0)
    mend()
    idempotent_append(spark, log=log, path=path)(rows(spark, 100, 6), 0)
    assert values(O.read_partitioned(spark, path)) == list(range(6))


def test_replay_after_compaction_adds_nothing(spark, monkeypatch):
    O.create_database(spark, C.DATABASE)
    table, log = f"{C.DATABASE}.c_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t_commit_log")
    for b in range(3):
        idempotent_append(spark, log=log, table=table)(rows(spark, 10 * b, 10), b)
    mend = crashing(monkeypatch, "write", 2)           # all files of batch 3 moved, its marker is missing
    with pytest.raises(Crash):
        idempotent_append(spark, log=log, table=table)(rows(spark, 30, 10), 3)
    mend()
    spark.catalog.recoverPartitions(table)
    O.compact(spark, table)
    idempotent_append(spark, log=log, table=table)(rows(spark, 30, 10), 3)
    assert values(spark.table(table)) == list(range(40))


@pytest.mark.parametrize("method,nth", [("rename", 1), ("rename", 3), ("delete", 1), ("delete", 4), ("write", 2)])
def test_interrupted_compaction_is_finished(spark, monkeypatch, method, nth):
    O.create_database(spark, C.DATABASE)
    table, log = f"{C.DATABASE}.c_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t_commit_log")
    for b in range(3):
        idempotent_append(spark, log=log, table=table)(rows(spark, 10 * b, 10), b)
    mend = crashing(monkeypatch, method, nth)
    with pytest.raises(Crash):
        O.compact(spark, table)
    mend()
    O.compact(spark, table)
    assert values(spark.table(table)) == list(range(30))
    assert O.file_count(spark, table) == 3


def test_hot_partition_is_packed_by_several_tasks(spark):
    O.create_database(spark, C.DATABASE)
    table = f"{C.DATABASE}.c_{uuid.uuid4().hex[:8]}"
    hot = spark.range(60_000).select(F.col("id").alias("v"), F.rand(1).alias("x"), F.lit("2024-01-01").cast("date").alias("current_day"), F.lit("HOT").alias("currency"))
    cold = hot.limit(6000).select("v", "x", "current_day", F.concat(F.lit("C"), (F.col("v") % 5).cast("string")).alias("currency"))
    for part in (hot.repartition(40), cold.repartition(2)):
        part.write.mode("append").format("orc").partitionBy("current_day", "currency").saveAsTable(table)
    root = K.location_of(spark, table)
    sizes = O.size_histogram(spark, root)
    total = sizes.agg(F.sum("bytes")).first()[0]
    target = total // 8
    before = sorted(map(tuple, spark.table(table).select("v", "x", "currency").collect()))
    names = set(spark.table(table).inputFiles())
    got = O.compact(spark, table, target_bytes=target)
    assert sorted(map(tuple, got.select("v", "x", "currency").collect())) == before
    per = {r.currency: r.n for r in got.select("currency", F.input_file_name().alias("f")).groupBy("currency").agg(F.countDistinct("f").alias("n")).collect()}
    assert 5 <= per["HOT"] <= 10 and all(per[f"C{i}"] == 1 for i in range(5))
    hot_sizes = [r.bytes / r.files for r in O.size_histogram(spark, root).where("folder like '%HOT'").collect()]
    assert all(target / 3 <= b <= 2 * target for b in hot_sizes)
    # large files, and small ones that are alone, stay as they are
    names = set(got.inputFiles())
    O.compact(spark, table, target_bytes=target // 4)
    assert set(spark.table(table).inputFiles()) == names


def test_large_files_are_left_alone(spark):
    O.create_database(spark, C.DATABASE)
    table = f"{C.DATABASE}.c_{uuid.uuid4().hex[:8]}"
    for n in (20_000, 30, 20):
        O.append_partitioned(rows(spark, 0, n).withColumn("currency", F.lit("A")).coalesce(1), table=table)
    size = {f: os.path.getsize(f.replace("file://", "").replace("file:", "")) for f in spark.table(table).inputFiles()}
    largest = max(size, key=size.get)
    O.compact(spark, table, target_bytes=size[largest])
    assert largest in spark.table(table).inputFiles()
    assert O.file_count(spark, table) == 2 and spark.table(table).count() == 20_050
