"""Rolling history context and z-scores inside the streaming fan-out (D1, D2 on a stream).

Window functions over rows are not available on a stream, and re-reading the
whole window (a year) for every 30-second micro-batch does not scale. Each
batch instead reads a bounded amount of state, all of it kept in the shared
folder:

* ``rows/bucket=B/batch_id=N``: a slim copy (key, kafka_ts, value, id) of
  every processed row, partitioned by event-time bucket (a day);
* ``daily/bucket=B/version=N``: one summary row per key (n, dsum, m2, min, max) of
  a day's rows from batches up to N;
* the context rows given out so far, ``bucket=B/batch_id=N`` below ``context_path``.

The frame [t - W, t) of each row of a batch is rebuilt exactly
(``rolling_range_stats`` with targets and summaries): raw rows of the row's own day and
of the day where its frame starts, summaries of the days between. The newest day is
summarised from its raw rows, every other one from its newest version.

Rows may come in any order. A row that is late changes what was already given out, and is
handled as a change to a view:

* a batch with rows of a summarised day merges them into its summary and writes the
  next version, so later frames hold them;
* context rows whose frames hold a row of this batch get the batch's statistics over
  their frames added to theirs and are given out again; only days from the late row
  on, up to W, and only its key's rows are read, and raw rows of those days are not.

``current_context`` reads the newest row of each event: after any order of arrival it
equals the batch window. Every write overwrites its own (bucket, batch) or (bucket,
version) folder and reads of batch N ignore what batch N wrote, so a replay changes
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.operators.history import YEAR_US, zscore_columns
from releaseflow.operators.rolling import (
    DAY_US,
    STAT_NAMES,
    bucket_summaries,
    combined,
    merge_summaries,
    rolling_range_stats,
)
from releaseflow.session import partition_values
from releaseflow.sources.versions import VersionedBuckets

#: Statistics that a context row keeps, so that a late row can be added to them.
KEPT = ("dsum", "m2", "min", "max")


@dataclass
class StreamingHistory:
    spark: SparkSession
    root: str
    window_us: int = YEAR_US
    bucket_us: int = DAY_US
    key: str = "indicator"
    id_col: str = "event_id"
    context_path: str | None = None

    def __post_init__(self):
        if self.window_us % self.bucket_us:
            raise ValueError("window must be a multiple of the bucket")
        self.root = self.root.rstrip("/")
        self.context_path = (self.context_path or f"{self.root}/context").rstrip("/")
        self.m = self.window_us // self.bucket_us
        self.daily = VersionedBuckets(self.spark, f"{self.root}/daily")

    # -- storage ------------------------------------------------------------------------------
    def _slim(self, df: DataFrame) -> DataFrame:
        """Rows that have a time, thus a frame."""
        return df.filter(F.col("kafka_ts").isNotNull()).select(self.key, "kafka_ts", F.col("value").cast("double").alias("value"), self.id_col,
                         F.floor(F.unix_micros("kafka_ts") / F.lit(self.bucket_us)).alias("bucket"))

    def _buckets(self, path: str) -> set[int]:
        return {int(v) for v in partition_values(self.spark, path, "bucket")}

    def _read(self, base: str, buckets: list[int], before_batch: int) -> DataFrame:
        return (self.spark.read.option("basePath", base).parquet(*(f"{base}/bucket={b}" for b in buckets))
                .filter(F.col("batch_id") < F.lit(before_batch))
                .withColumn("bucket", F.col("bucket").cast("long")))

    def _rows(self, buckets: list[int], before_batch: int) -> DataFrame | None:
        if not buckets:
            return None
        return self._read(f"{self.root}/rows", buckets, before_batch).select(
            self.key, "kafka_ts", "value", self.id_col, "bucket")

    def _summarise(self, rows: DataFrame) -> DataFrame:
        return bucket_summaries(rows, [self.key], "kafka_ts", "value", self.bucket_us)

    def _days(self, slim: DataFrame) -> list[int]:
        return sorted(int(r[0]) for r in slim.select("bucket").distinct().collect())

    # -- per micro-batch ------------------------------------------------------------------------
    def process(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Context rows of this batch (event_id, key, kafka_ts, value, hist_*, zscore): of its own
        rows, and of earlier rows whose frames hold one of them.

        Call once per micro-batch, in batch order; then ``emit`` the result and ``commit`` the batch.
        """
        slim = self._slim(batch)
        days = self._days(slim)
        own = self._contexts(slim, days, batch_id)
        revised = self._revised(slim, days, batch_id) if days else None
        stats = own if revised is None else own.unionByName(revised)
        return zscore_columns(stats, "hist_", keep=KEPT)

    def _contexts(self, slim: DataFrame, days: list[int], batch_id: int) -> DataFrame:
        """Statistics of the batch's own rows."""
        stored = self._buckets(f"{self.root}/rows") if days else set()
        raw = self._rows(sorted(({*days} | {d - self.m for d in days}) & stored), batch_id)
        data = slim.withColumn("_target", F.lit(True))
        if raw is not None:
            data = data.unionByName(raw.withColumn("_target", F.lit(False)))

        between = {b for d in days for b in range(d - self.m + 1, d)} & stored
        newest = {max([*stored, *days], default=0)}
        closed = sorted(between - newest)
        missing = [b for b in closed if self.daily.newest(b, batch_id) is None]
        if missing:
            self.daily.write(self._summarise(self._rows(missing, batch_id)), missing, batch_id - 1)
        parts = self._summarise(slim)
        fresh = self._rows(sorted(between & newest), batch_id)
        for more in (None if fresh is None else self._summarise(fresh), self.daily.read(closed, batch_id)):
            parts = parts if more is None else parts.unionByName(more)
        return rolling_range_stats(data.drop("bucket"), [self.key], "kafka_ts", "value", [self.id_col],
                                   self.window_us, self.bucket_us, target_col="_target",
                                   summaries=merge_summaries(parts, [self.key])).drop("_target")

    def _revised(self, slim: DataFrame, days: list[int], batch_id: int) -> DataFrame | None:
        """Statistics of earlier rows whose frames hold rows of this batch, with those added."""
        reach = {b for d in days for b in range(d, d + self.m + 1)}
        given = sorted(self._buckets(self.context_path) & reach)
        if not given:
            return None
        span = slim.groupBy(self.key).agg(F.min("kafka_ts").alias("_from"), F.max("kafka_ts").alias("_to"))
        t, window = F.unix_micros("kafka_ts"), F.lit(self.window_us)
        old = (self._read(self.context_path, given, batch_id).join(span, self.key)
               .filter((F.col("kafka_ts") > F.col("_from")) & (t <= F.unix_micros("_to") + window)))
        old = newest_rows(old, self.id_col).select(
            self.key, "kafka_ts", "value", self.id_col, *[F.col(f"hist_{s}") for s in STAT_NAMES])
        asked = old.select(self.key, "kafka_ts", F.lit(None).cast("double").alias("value"), self.id_col,
                           F.lit(True).alias("_target"))
        added = rolling_range_stats(slim.drop("bucket").withColumn("_target", F.lit(False)).unionByName(asked),
                                    [self.key], "kafka_ts", "value", [self.id_col], self.window_us, self.bucket_us,
                                    prefix="add_", target_col="_target").filter("add_n > 0")
        both = old.join(added.select(self.id_col, *[f"add_{s}" for s in STAT_NAMES]), self.id_col)
        return both.select(self.key, "kafka_ts", "value", self.id_col, *combined(["hist_", "add_"], "hist_"))

    def emit(self, context: DataFrame, batch_id: int) -> None:
        """Give out the context rows of a batch (idempotent per (bucket, batch_id))."""
        (context.withColumn("bucket", F.floor(F.unix_micros("kafka_ts") / F.lit(self.bucket_us)))
         .withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(self.context_path))

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        """Record the batch's slim rows and add them to the summaries of days that have one."""
        slim = self._slim(batch)
        (slim.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(f"{self.root}/rows"))
        changed = [b for b in self._days(slim) if self.daily.newest(b, batch_id) is not None]
        if changed:
            late = self._summarise(slim.filter(F.col("bucket").isin(changed)))
            both = late.unionByName(self.daily.read(changed, batch_id))
            self.daily.write(merge_summaries(both, [self.key]), changed, batch_id)


def newest_rows(context: DataFrame, id_col: str = "event_id") -> DataFrame:
    """Of each event the context row given out last."""
    row = F.struct(*(F.col(c) for c in context.columns if c != id_col))
    return (context.groupBy(id_col).agg(F.max_by(row, "batch_id").alias("_row")).select(id_col, "_row.*"))


def current_context(spark: SparkSession, path: str, id_col: str = "event_id") -> DataFrame:
    """Context rows below ``path`` with every late row accounted for."""
    return newest_rows(spark.read.parquet(path), id_col).drop("bucket", "batch_id")
