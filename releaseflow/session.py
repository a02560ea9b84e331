"""SparkSession construction and shared-storage helpers.

Cluster settings (checkpoint dir, shuffle partitions, memory) come from
``spark-submit``; the builder here only fills in what is unset, so the same
code runs on ``local[8]`` in tests and on a large cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults applied only when the caller has not configured them.
_SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Timestamps of this type carry min/max statistics, so filters on them skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Dynamic partition overwrite makes batch_id=N/ writes replay-safe.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "releaseflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All date/timestamp logic in the library assumes a UTC session clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and derived tables.

    Read from ``spark.checkpoint.dir``; only in local mode (tests, smoke checks)
    may it be unset: a fresh private folder is then set, once.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="releaseflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str, unique: bool = False) -> str:
    """A path below the shared folder (``file:`` or a cluster filesystem URI)."""
    base = shared_dir(spark)
    suffix = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{base}/releaseflow/{suffix}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python helpers can test existence."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on the cluster file system (local, HDFS, object stores)."""
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of derived state that nothing can read any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def make_path(spark: SparkSession, path: str) -> None:
    """Create an empty folder (and its parents)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)  # noqa: SLF001


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern on the cluster file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)  # noqa: SLF001
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)  # noqa: SLF001
    return [st.getPath().toString() for st in found or []]


def partition_values(spark: SparkSession, root: str, column: str) -> set[str]:
    """Values of ``column=value`` sub-folders directly under ``root`` (one listing call)."""
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    if not fs.exists(p):
        return set()
    prefix = f"{column}="
    out = set()
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            out.add(name[len(prefix):])
    return out
