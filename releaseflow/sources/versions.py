"""Small derived state on a stream: one folder per bucket and version, newest wins.

    root/bucket=B/version=N/part-*.parquet

Version N of a bucket replaces the earlier ones; a micro-batch with id N writes version N
and reads versions below N, so its replay reads what its first run read and overwrites
what that wrote. The two newest versions of a bucket are kept: older ones can't be read again
and are removed, so the number of folders follows the buckets, not the batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.session import delete_path, partition_values

KEPT_VERSIONS = 2


@dataclass
class VersionedBuckets:
    spark: SparkSession
    root: str
    _known: dict[int, set[int]] = field(default_factory=dict, repr=False)

    def newest(self, bucket: int, before: int) -> int | None:
        """Newest version of a bucket below ``before``."""
        if bucket not in self._known:  # listed once; this process writes all later ones
            self._known[bucket] = {int(v) for v in partition_values(
                self.spark, f"{self.root}/bucket={bucket}", "version")}
        return max((v for v in self._known[bucket] if v < before), default=None)

    def read(self, buckets: list[int], before: int) -> DataFrame | None:
        """Rows of the newest versions below ``before``, with ``bucket``; None if there are none."""
        found = [(b, self.newest(b, before)) for b in buckets]
        paths = [f"{self.root}/bucket={b}/version={v}" for b, v in found if v is not None]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self.root).parquet(*paths)
        return rows.withColumn("bucket", F.col("bucket").cast("long")).drop("version")

    def write(self, rows: DataFrame, buckets: list[int], version: int) -> None:
        """``rows`` (with ``bucket``) as this version of ``buckets``."""
        (rows.withColumn("version", F.lit(version)).coalesce(max(1, min(8, len(buckets))))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "version").parquet(self.root))
        for b in buckets:
            self.newest(b, version)
            self._known[b].add(version)
            for old in sorted(self._known[b])[:-KEPT_VERSIONS]:
                delete_path(self.spark, f"{self.root}/bucket={b}/version={old}")
                self._known[b].discard(old)


def newest_versions(spark: SparkSession, root: str) -> DataFrame:
    """All buckets' newest rows, with ``bucket``."""
    rows = spark.read.parquet(root)
    top = rows.select("bucket", "version").distinct().groupBy("bucket").agg(F.max("version").alias("version"))
    return rows.join(top, ["bucket", "version"], "left_semi").drop("version")
