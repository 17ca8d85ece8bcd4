"""Publication of staged files in two phases.

A unit of work (a micro-batch, a compaction) writes its files under a hidden staging folder, where no
reader looks.  The first phase ends with a manifest: one file, made visible by one rename, that lists
every staged file with its place in the table and every file that it replaces.  The second
phase carries the manifest out: staged files are renamed to their places, replaced files are
deleted.  Both steps can be repeated: a staged file that is gone has been moved, a replaced file that is gone has been deleted.

* A crash before the manifest leaves staged files only; the next attempt writes them anew, in place of the old ones.
* A crash behind it is finished from the manifest by the next attempt, whatever rows that attempt brings.

So every unit is in the table exactly once, also if its files have been compacted away meanwhile.  It
takes a file system whose rename is atomic (HDFS, ABFS, local).  The manifest lists files, never rows.
"""

from __future__ import annotations

import hashlib
import json
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PARTITIONS_PER_STATEMENT = 500


class Files:
    """The Hadoop file system of a path, as far as it is needed here."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self.path(path)))

    def rename(self, source: str, target: str) -> bool:
        """False where it did not succeed; some file systems say so, others raise."""
        try:
            return bool(self._fs.rename(self.path(source), self.path(target)))
        except Py4JJavaError:
            return False

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self.path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs.open(self.path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str = "") -> None:
        """The whole file or nothing: written aside, then renamed."""
        aside = f"{path}._writing"
        out = self._fs.create(self.path(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.rename(aside, path) and not self.exists(path):
            raise OSError(f"could not write {path}")

    def names(self, path: str) -> list[str]:
        """Names of the entries of a folder; none if it does not exist."""
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(path))] if self.exists(path) else []

    def data_files(self, root: str) -> list[tuple[str, str]]:
        """(folder relative to ``root``, name) of the data files below it."""
        out = []
        if self.exists(root):
            base = self._fs.makeQualified(self.path(root)).toString().rstrip("/") + "/"
            found = self._fs.listFiles(self.path(root), True)
            while found.hasNext():
                full = found.next().getPath().toString()
                folder, _, name = full[len(base):].rpartition("/")
                if name[0] not in "_." and not any(p[:1] in ("_", ".") and "=" not in p for p in folder.split("/")):
                    out.append((folder, name))
        return out


def location_of(spark: SparkSession, table: str) -> str:
    """Folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"].rstrip("/")


class Publication:
    """One unit of work ``name`` of a log folder: planned, published, committed."""

    def __init__(self, spark: SparkSession, log: str, name: str):
        self.spark, self.log, self.name = spark, log.rstrip("/"), name
        self.files = Files(spark, log)
        self.marker, self.manifest = f"{self.log}/{name}", f"{self.log}/{name}.manifest"

    @property
    def committed(self) -> bool:
        return self.files.exists(self.marker)

    @property
    def planned(self) -> bool:
        return self.files.exists(self.manifest)

    def plan(self, root: str, staged: str, tag: str, replaced: list[str] | None = None) -> None:
        """Ends the first phase: all data files below ``staged`` are to go to the same folders below ``root``."""
        add = [(f"{staged}/{folder}/{name}" if folder else f"{staged}/{name}",
                f"{root}/{folder}/{tag}-{name}" if folder else f"{root}/{tag}-{name}", folder)
               for folder, name in Files(self.spark, staged).data_files(staged)]
        self.files.mkdirs(self.log)
        self.files.write(self.manifest, json.dumps({"staged": staged, "add": add, "remove": replaced or []}))

    def publish(self, table: str | None = None) -> None:
        """The second phase, from the manifest; can be repeated."""
        plan = json.loads(self.files.read(self.manifest))
        data = Files(self.spark, plan["staged"])
        for folder in sorted({target.rpartition("/")[0] for _, target, _ in plan["add"]}):
            data.mkdirs(folder)
        for source, target, _ in plan["add"]:
            if not data.rename(source, target) and data.exists(source):
                raise OSError(f"could not move {source} to {target}")
        for path in plan["remove"]:
            data.delete(path)
        if table:
            register_partitions(self.spark, table, {folder for _, _, folder in plan["add"] if folder})
        self.files.write(self.marker)
        data.delete(plan["staged"])
        self.files.delete(self.manifest)


def _literal(value: str) -> str:
    if value == NULL_PARTITION:
        return "null"
    return "'" + unquote(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_partitions(spark: SparkSession, table: str, folders: set[str]) -> None:
    """Makes partition folders known to the catalog."""
    specs = []
    for folder in sorted(folders):
        pairs = [p.split("=", 1) for p in folder.split("/")]
        specs.append("PARTITION (" + ", ".join(f"`{unquote(c)}` = {_literal(v)}" for c, v in pairs) + ")")
    for i in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(specs[i:i + PARTITIONS_PER_STATEMENT])}")
    spark.catalog.refreshTable(table)


def staging(root: str, owner: str) -> str:
    """Hidden folder of one writer within a table."""
    return f"{root}/_staged/{hashlib.sha256(owner.encode()).hexdigest()[:12]}"


class StagedAppend:
    """Appends numbered batches to a partitioned table, each exactly once.

    ``write`` lays a DataFrame out and saves it at a path.  ``log`` is the writer's own folder, kept as long as
    batches can come again (a stream keeps it in its checkpoint)."""

    def __init__(self, spark: SparkSession, log: str, write, *, table: str | None = None, path: str | None = None, create=None):
        if not (table or path):
            raise ValueError("table or path is required")
        self.spark, self.log, self.write = spark, log.rstrip("/"), write
        self.table, self.path, self.create = table, path, create

    def unit(self, batch_id: int) -> Publication:
        return Publication(self.spark, self.log, f"batch-{batch_id:012d}")

    def append(self, df: DataFrame | None, batch_id: int) -> None:
        """Adds the batch, or finishes or skips it if an earlier attempt got that far."""
        unit = self.unit(batch_id)
        if unit.committed:
            return
        if not unit.planned:
            if df is None:
                unit.files.mkdirs(self.log)
                unit.files.write(unit.marker)
                return
            if self.table and not self.spark.catalog.tableExists(self.table):
                self.create(df, self.table, self.path)
            root = (location_of(self.spark, self.table) if self.table else self.path).rstrip("/")
            staged = f"{staging(root, self.log)}/{unit.name}"
            self.write(df, staged)
            unit.plan(root, staged, f"{unit.name}-{staged.split('/')[-2]}")
        unit.publish(self.table)
