"""Registered queries over the written, versioned table.

The table is backfilled from the events-derived enriched rows (one batch per
1,000 offsets, commit time = newest processed_ts of the batch) into the
session's shared folder, once per session and input directory.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from releaseflow.operators import maintenance as M
from releaseflow.plans.common import AS_OF, enriched, presentable, register
from releaseflow.plans.enrichment import ENRICHED_OUT
from releaseflow.plans.ingest import _ENRICHED_OUT_SQL
from releaseflow.plans.oracle import ts, with_base
from releaseflow.session import scratch_path
from releaseflow.sources.table import VersionedTable

AS_OF_VERSION = 3
AS_OF_TIMESTAMP = "2024-01-10 00:00:00"
HISTORY_N = 5
SCAN_SOURCE = "BLS"
SCAN_SINCE = "2024-01-15"

_built: dict[tuple[str, str], VersionedTable] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir)


def release_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    k = _key(spark, sf_dir)
    if k not in _built:
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
        t = VersionedTable(spark, scratch_path(spark, f"tables/{tag}/releases_enriched", unique=True))
        t.write_all(enriched(spark, sf_dir).drop("seq"), replace_partitions=False)
        _built[k] = t
    return _built[k]


def compacted_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    k = ("compacted",) + _key(spark, sf_dir)
    if k not in _built:
        src = release_table(spark, sf_dir)
        _built[k] = M.compact(src, src.root + "_compacted")
    return _built[k]


@register("scan_enriched", with_base(f"""
SELECT {_ENRICHED_OUT_SQL} FROM enr
WHERE source = '{SCAN_SOURCE}' AND processing_date >= DATE '{SCAN_SINCE}'"""))
def q_scan_enriched(spark, sf_dir):
    t = release_table(spark, sf_dir)
    return presentable(t.scan(sources=[SCAN_SOURCE], since=SCAN_SINCE).select(*ENRICHED_OUT))


@register("as_of_version", with_base(f"SELECT {_ENRICHED_OUT_SQL} FROM enr WHERE batch_id <= {AS_OF_VERSION}"))
def q_as_of_version(spark, sf_dir):
    return presentable(release_table(spark, sf_dir).as_of_version(AS_OF_VERSION).select(*ENRICHED_OUT))


_COMMITS_SQL = ("commits AS (SELECT batch_id, max(processed_ts) AS commit_ts, count(*) AS num_rows "
                "FROM enr GROUP BY batch_id)")


@register("as_of_timestamp", with_base(f"""
SELECT {_ENRICHED_OUT_SQL} FROM enr
WHERE batch_id <= (SELECT max(batch_id) FROM commits WHERE commit_ts <= TIMESTAMP '{AS_OF_TIMESTAMP}')""",
                                       _COMMITS_SQL))
def q_as_of_timestamp(spark, sf_dir):
    return presentable(release_table(spark, sf_dir).as_of_timestamp(AS_OF_TIMESTAMP).select(*ENRICHED_OUT))


@register("table_history", with_base(f"""
SELECT batch_id AS version, {ts('commit_ts', 'timestamp')}, 'STREAMING UPDATE' AS operation,
       num_rows AS num_output_rows
FROM commits ORDER BY version DESC LIMIT {HISTORY_N}""", _COMMITS_SQL))
def q_table_history(spark, sf_dir):
    return presentable(release_table(spark, sf_dir).history(HISTORY_N))


@register("compacted_scan", with_base(f"SELECT {_ENRICHED_OUT_SQL} FROM enr"))
def q_compacted_scan(spark, sf_dir):
    return presentable(compacted_table(spark, sf_dir).scan().select(*ENRICHED_OUT))


ZORDER_RELEASE, ZORDER_SINCE = "FRED_CPI", "2024-01-25"


def zordered_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    k = ("zordered",) + _key(spark, sf_dir)
    if k not in _built:
        src = release_table(spark, sf_dir)
        _built[k] = M.zorder(src, src.root + "_zordered")
    return _built[k]


@register("zorder_scan", with_base(f"""
SELECT {_ENRICHED_OUT_SQL} FROM enr
WHERE release_name = '{ZORDER_RELEASE}' AND processed_ts >= TIMESTAMP '{ZORDER_SINCE} 00:00:00'"""))
def q_zorder_scan(spark, sf_dir):
    """The Z-ordered copy, filtered on two of its columns: both reach the files' statistics."""
    df = M.with_newer_batches(release_table(spark, sf_dir), zordered_table(spark, sf_dir))
    df = df.filter((F.col("release_name") == ZORDER_RELEASE)
                   & (F.col("processed_ts") >= F.lit(ZORDER_SINCE).cast("timestamp")))
    return presentable(df.select(*ENRICHED_OUT))


@register("retention_candidates", with_base(f"""
SELECT batch_id, {ts('commit_ts')}, num_rows FROM commits
WHERE commit_ts < TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR
  AND batch_id < (SELECT max(batch_id) FROM commits)""", _COMMITS_SQL))
def q_retention_candidates(spark, sf_dir):
    return presentable(M.retention_candidates(release_table(spark, sf_dir), 168, AS_OF))
