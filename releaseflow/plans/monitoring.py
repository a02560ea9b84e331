"""Registered queries for windowed counts and lag monitoring."""

from __future__ import annotations

from releaseflow.operators.monitor import offset_lag, windowed_counts
from releaseflow.plans.common import enriched, presentable, register, releases
from releaseflow.plans.oracle import ts, with_base
from releaseflow.plans.table import AS_OF_VERSION, release_table


@register("windowed_counts", with_base(f"""
SELECT {ts('time_bucket(INTERVAL 1 HOUR, kafka_ts)', 'window_start')},
       {ts('time_bucket(INTERVAL 1 HOUR, kafka_ts) + INTERVAL 1 HOUR', 'window_end')},
       source,
       count(*) AS n_events,
       CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalies,
       CAST(sum(CASE WHEN market_impact = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS n_high_impact
FROM enr GROUP BY time_bucket(INTERVAL 1 HOUR, kafka_ts), source"""))
def q_windowed_counts(spark, sf_dir):
    return presentable(windowed_counts(enriched(spark, sf_dir), "1 hour"))


@register("lag_report", with_base(f"""
SELECT e."partition", e.end_offset, coalesce(c.committed_offset, 0) AS committed_offset,
       e.end_offset - coalesce(c.committed_offset, 0) AS lag,
       CAST(sum(e.end_offset - coalesce(c.committed_offset, 0)) OVER () AS BIGINT) AS total_lag,
       sum(e.end_offset - coalesce(c.committed_offset, 0)) OVER () > 10000 AS alert
FROM (SELECT "partition", max("offset") + 1 AS end_offset FROM rel GROUP BY 1) e
LEFT JOIN (SELECT "partition", max("offset") + 1 AS committed_offset FROM enr
           WHERE batch_id <= {AS_OF_VERSION} GROUP BY 1) c ON e."partition" = c."partition\""""))
def q_lag_report(spark, sf_dir):
    """Offsets on the raw topic against what the table holds at version 3."""
    consumed = release_table(spark, sf_dir).as_of_version(AS_OF_VERSION).select("partition", "offset")
    return offset_lag(releases(spark, sf_dir).select("partition", "offset"), consumed)
