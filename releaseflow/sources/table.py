"""Batch-versioned, partitioned Parquet table of enriched releases.

Layout under ``root``::

    data/source=S/processing_date=D/batch_id=N/part-*.parquet              micro-batches
    backfill/load=L/source=S/processing_date=D/part-*.parquet              many batches in one write
    replaced/part-*.parquet    load, source, processing_date, batch_id: rows of a load that are no longer read
    commits/bucket=B/version=V/part-*.parquet    a row per batch: commit_ts, operation, num_rows

A version of the table is a micro-batch id. The batches of a backfill share the files of their source and day
(``batch_id`` is a column there), so files follow days and bytes, not batches. Source and day come first, so a read of some sources
and days (``scan`` with its arguments) lists only their folders, however many batches there are. The commit
rows of ``COMMIT_BUCKET`` batches share a file, which is written anew with each commit.

Replaying a batch (after a failure or a restart) replaces it instead of adding a second copy, even
when the replay computes a different processing_date: a batch that has a commit row, or the mark
of an attempt that didn't end, is removed from all folders first; in a load's shared files, which are
never rewritten, it is noted as replaced. The commit row (used by history and timestamp reads) is
written after the data.

There is no transaction log: one writer per table is assumed and a reader
may observe a batch while it is being written.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from releaseflow.schema import SINK_PARTITION_COLUMNS
from releaseflow.session import delete_path, make_path, matching_paths, partition_values, path_exists
from releaseflow.sources.versions import VersionedBuckets

COMMIT_SCHEMA = "commit_ts timestamp, operation string, num_rows long, batch_id long"
COMMIT_COLUMNS = ["commit_ts", "operation", "num_rows", "batch_id"]
#: Batches whose commit rows share a file.
COMMIT_BUCKET = 1000
_ANY = 1 << 62
_PARTITION = [*SINK_PARTITION_COLUMNS, "batch_id"]
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _matching(rows: DataFrame, keys: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join in which nulls are equal."""
    keys = keys.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return rows.join(keys, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]), how)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.root}/commits"

    @property
    def backfill_path(self) -> str:
        return f"{self.root}/backfill"

    @property
    def replaced_path(self) -> str:
        return f"{self.root}/replaced"

    # -- commits ------------------------------------------------------------------
    def _log(self) -> VersionedBuckets:
        return VersionedBuckets(self.spark, self.commits_path)

    def record_commits(self, rows: DataFrame) -> None:
        """Add commit rows (commit_ts, operation, num_rows, batch_id); a batch's new row replaces its old one."""
        new = rows.select(*COMMIT_COLUMNS).withColumn(
            "bucket", F.floor(F.col("batch_id") / F.lit(COMMIT_BUCKET))).persist()
        try:
            log, both = self._log(), new
            buckets = sorted(r[0] for r in new.select("bucket").distinct().collect())
            old = log.read(buckets, _ANY)
            if old is not None:
                both = new.unionByName(old.join(new.select("batch_id"), "batch_id", "left_anti").select(*new.columns))
            version = 1 + max((v for b in buckets if (v := log.newest(b, _ANY)) is not None), default=-1)
            log.write(both, buckets, version)
        finally:
            new.unpersist()

    # -- writes -----------------------------------------------------------------
    def write_batch(self, df: DataFrame, batch_id: int, commit_ts: datetime | str | None = None,
                    operation: str = "STREAMING UPDATE") -> int:
        """Idempotent append of one micro-batch; returns the rows written.

        The row count comes from an ``observe`` metric of the write itself, so
        the batch is evaluated once.
        """
        mark = f"{self.root}/_writing/batch_id={batch_id}"
        unsure = path_exists(self.spark, mark) or path_exists(self.spark, self._backfill_mark)
        if unsure or not self.commits().filter(F.col("batch_id") == batch_id).isEmpty():
            self._drop_batch(batch_id)
        make_path(self.spark, mark)
        # Unique name: the fan-out writes several tables for the same batch concurrently.
        obs = Observation(f"write_batch_{batch_id}_{uuid.uuid4().hex}")
        (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
           .observe(obs, F.count(F.lit(1)).alias("n"))
           .hint("rebalance", *SINK_PARTITION_COLUMNS)  # write-time compaction: AQE sizes the files
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")  # only this batch's folders
           .partitionBy(*SINK_PARTITION_COLUMNS, "batch_id")
           .parquet(self.data_path))
        n = int(obs.get.get("n", 0))
        ts = F.current_timestamp() if commit_ts is None else F.lit(commit_ts).cast("timestamp")
        self.record_commits(self.spark.range(1).select(
            ts.alias("commit_ts"), F.lit(operation).alias("operation"), F.lit(n).cast("long").alias("num_rows"),
            F.lit(batch_id).cast("long").alias("batch_id")))
        delete_path(self.spark, mark)
        return n

    def _drop_batch(self, batch_id: int) -> None:
        folders = "/".join(f"{c}=*" for c in SINK_PARTITION_COLUMNS)
        for path in matching_paths(self.spark, f"{self.data_path}/{folders}/batch_id={batch_id}"):
            self._delete_folder(path)
        loads = self._loads()
        if loads:
            self._note_replaced(self._backfilled(loads).filter(F.col("batch_id") == batch_id))

    def _delete_folder(self, path: str) -> None:
        """Remove a batch's folder, and its day's and source's if they are empty then."""
        delete_path(self.spark, path)
        for column in reversed(_PARTITION[1:]):
            path = path.rsplit("/", 1)[0]
            if not partition_values(self.spark, path, column):
                delete_path(self.spark, path)

    def _note_replaced(self, rows: DataFrame) -> None:
        gone = rows.select("load", *_PARTITION).distinct().coalesce(1).persist()
        try:
            if not gone.isEmpty():
                gone.write.mode("append").parquet(self.replaced_path)
        finally:
            gone.unpersist()

    def write_all(self, df: DataFrame, commit_ts_col: str = "processed_ts",
                  operation: str = "STREAMING UPDATE", replace_partitions: bool = True) -> None:
        """Backfill many batches in one job (``df`` carries ``batch_id``).

        With ``replace_partitions`` only the (source, processing_date, batch_id) present are
        replaced; else the rows are the whole table. The ``rebalance`` hint lets AQE split
        hot days and merge small ones, so file sizes stay even and their number follows
        the days and bytes, however many batches there are. Commit rows are derived from
        the written files (two columns), so the input is computed only once.
        """
        earlier = self._loads()
        load = 1 + max((int(v) for v in partition_values(self.spark, self.backfill_path, "load")), default=-1)
        make_path(self.spark, self._backfill_mark)
        (df.hint("rebalance", *SINK_PARTITION_COLUMNS)
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "static")
           .partitionBy(*SINK_PARTITION_COLUMNS)
           .parquet(f"{self.backfill_path}/load={load}"))
        if replace_partitions:
            self._replace_partitions(load, earlier)
        else:
            for path in (self.data_path, *(f"{self.backfill_path}/load={n}" for n in earlier), self.replaced_path):
                delete_path(self.spark, path)
        commits = (self.scan().groupBy("batch_id")
                   .agg(F.max(commit_ts_col).alias("commit_ts"), F.count(F.lit(1)).alias("num_rows")))
        self.record_commits(commits.withColumn("operation", F.lit(operation)))
        delete_path(self.spark, self._backfill_mark)

    @property
    def _backfill_mark(self) -> str:
        return f"{self.root}/_writing/backfill"

    def _replace_partitions(self, load: int, earlier: list[int]) -> None:
        """What a load holds anew is no longer read from earlier loads and micro-batches."""
        if load not in self._loads():  # no rows
            return
        new = self._backfilled([load]).select(*_PARTITION).distinct()
        if earlier:
            self._note_replaced(_matching(self._backfilled(earlier), new, _PARTITION, "left_semi"))
        if not self._has_batches():
            return
        old = self._typed(self.spark.read.parquet(self.data_path)).select(*_PARTITION).distinct()
        gone = {tuple(None if v is None else str(v) for v in r)
                for r in _matching(old, new, _PARTITION, "left_semi").collect()}
        folders = "/".join(f"{c}=*" for c in SINK_PARTITION_COLUMNS)
        for batch in sorted({r[2] or _NULL_FOLDER for r in gone}):
            for path in matching_paths(self.spark, f"{self.data_path}/{folders}/batch_id={batch}"):
                values = (unquote(f.split("=", 1)[1]) for f in path.split("/")[-3:])
                if tuple(None if v == _NULL_FOLDER else v for v in values) in gone:
                    self._delete_folder(path)

    # -- reads --------------------------------------------------------------------
    def commits(self) -> DataFrame:
        buckets = sorted(int(b) for b in partition_values(self.spark, self.commits_path, "bucket"))
        rows = self._log().read(buckets, _ANY)
        rows = self.spark.createDataFrame([], COMMIT_SCHEMA) if rows is None else rows
        return rows.select(F.col("batch_id").cast("long"), "commit_ts", "operation", "num_rows")

    def scan(self, sources: list[str] | None = None, since: date | str | None = None,
             until: date | str | None = None) -> DataFrame:
        """All rows, or those of some sources and processing dates (both ends included).

        With arguments only the folders they name are listed. Filters on source, processing_date and
        batch_id prune folders that are listed; other predicates push down to the Parquet reader. A batch
        whose writer died before its commit row is visible until the stream
        replays (and replaces) it: the no-log limit stated above."""
        part = None
        if sources is not None or since is not None or until is not None:
            part = (sources, str(since or ""), str(until or "9999-12-31"))
        loads, found = self._loads(), []
        if not loads or self._has_batches():
            found.append(self._typed(self._read(self.data_path, [self.data_path], part)))
        if loads:
            rows = self._backfilled(loads, part)
            found.append(rows.select(*(c for c in rows.columns if c not in ("load", *_PARTITION)), *_PARTITION))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)

    def _read(self, base: str, roots: list[str], part: tuple[list[str] | None, str, str] | None) -> DataFrame:
        reader = self.spark.read.option("basePath", base)
        if part is None:
            return reader.parquet(*roots)
        paths = [f for root in roots for f in self._folders(root, *part)]
        # Nothing written for them yet: the table's columns, no rows.
        return reader.parquet(*paths) if paths else reader.parquet(*roots).filter(F.lit(False))

    def _folders(self, root: str, sources: list[str] | None, since: str, until: str) -> list[str]:
        names = partition_values(self.spark, root, "source")
        out = []
        for s in sorted(names if sources is None else names & set(sources)):
            days = partition_values(self.spark, f"{root}/source={s}", "processing_date")
            out += [f"{root}/source={s}/processing_date={d}" for d in sorted(days) if since <= d <= until]
        return out

    def _has_batches(self) -> bool:
        return bool(partition_values(self.spark, self.data_path, "source"))

    def _loads(self) -> list[int]:
        """Backfills that wrote rows."""
        found = sorted(int(v) for v in partition_values(self.spark, self.backfill_path, "load"))
        return [n for n in found if partition_values(self.spark, f"{self.backfill_path}/load={n}", "source")]

    def _backfilled(self, loads: list[int], part: tuple[list[str] | None, str, str] | None = None) -> DataFrame:
        """Rows of backfills that nothing has replaced, with their ``load``."""
        rows = self._typed(self._read(self.backfill_path, [f"{self.backfill_path}/load={n}" for n in loads], part))
        if path_exists(self.spark, self.replaced_path):
            rows = _matching(rows, self.spark.read.parquet(self.replaced_path), ["load", *_PARTITION], "left_anti")
        return rows

    @staticmethod
    def _typed(data: DataFrame) -> DataFrame:
        return data.withColumn("batch_id", F.col("batch_id").cast("long"))

    def as_of_version(self, version: int) -> DataFrame:
        return self.scan().filter(F.col("batch_id") <= F.lit(version))

    def version_at(self, ts: datetime | str) -> DataFrame:
        """One-row frame: the newest version committed at or before ``ts``."""
        return (self.commits().filter(F.col("commit_ts") <= F.lit(ts).cast("timestamp"))
                .agg(F.max("batch_id").alias("version")))

    def as_of_timestamp(self, ts: datetime | str) -> DataFrame:
        """Rows of every batch up to the version current at ``ts`` (a scalar
        subquery: the version is resolved on the cluster, not in the driver)."""
        v = self.version_at(ts).scalar()
        return self.scan().filter(F.col("batch_id") <= v)

    def history(self, n: int = 10) -> DataFrame:
        return (self.commits()
                .select(F.col("batch_id").alias("version"), F.col("commit_ts").alias("timestamp"),
                        "operation", F.col("num_rows").alias("num_output_rows"))
                .orderBy(F.col("version").desc())
                .limit(n))
