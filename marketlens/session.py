"""Session factory and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every marketlens job relies on.  They are session-level SQL
# settings, so they can be applied to a session someone else built.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for large clusters (applied by ``get_session(profile="cluster")``):
# bigger scan splits, byte-sized shuffle partitions after AQE coalescing, and
# the RocksDB state store (state off the JVM heap, changelog checkpoints) for
# long-running event-time queries.
CLUSTER_SETTINGS: dict[str, str] = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "marketlens",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None,
                driver_memory: str | None = "8g", hive: bool = False,
                profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    The web UI stays off: jobs are non-interactive and open no extra port.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if hive:   # the cluster's shared metastore, as configured in its spark-defaults
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if profile == "cluster":
        for k, v in CLUSTER_SETTINGS.items():
            builder = builder.config(k, v)
    if driver_memory:   # local mode: the driver JVM is the executor
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the engine needs (UTC, AQE, dynamic overwrite)
    and make the package importable by Python workers."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the length of a block; what the caller had is restored."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            if old[k] != v:
                spark.conf.set(k, v)
        yield
    finally:
        for k, v in values.items():
            if old[k] is None:
                spark.conf.unset(k)
            elif old[k] != v:
                spark.conf.set(k, old[k])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers
    (``SparkContext.addPyFile`` of a zip of its sources), once per
    application.  Grouped-map and map-in-pandas functions refer to package
    functions by module, so workers must be able to import it."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="marketlens-pyfiles-"), "marketlens.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or a checkpoint directory already set
    on the context).  Only when neither exists on a local master (tests) do
    we make one of our own and register it with
    ``SparkContext.setCheckpointDir`` — the core setting itself cannot be
    changed at runtime.  On a cluster a machine-local folder would lose
    files, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = _OWN_DIRS.get(sc.applicationId) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="marketlens-ckpt-")
        _OWN_DIRS[sc.applicationId] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/marketlens/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    scans are pruned and pushed down, and no executor loss repeats the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
