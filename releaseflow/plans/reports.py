"""Registered queries for the analytics reports (A1-A10)."""

from __future__ import annotations

from releaseflow.operators import reports as R
from releaseflow.plans.common import AS_OF, SINCE_DAYS, enriched, presentable, register
from releaseflow.plans.oracle import dt, ts, with_base

_AGG_FILTER = "FROM enr WHERE surprise_pct IS NOT NULL GROUP BY release_name, source"


@register("surprise_analysis", with_base(f"""
SELECT release_name, source,
       count(*) AS n_releases,
       round(avg(abs(surprise_pct)), 2) AS mean_abs_surprise_pct,
       round(max(abs(surprise_pct)), 2) AS max_abs_surprise_pct,
       round(stddev_samp(surprise_pct), 2) AS surprise_std,
       CAST(sum(CASE WHEN surprise_pct > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_beats,
       CAST(sum(CASE WHEN surprise_pct < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_misses
{_AGG_FILTER}
ORDER BY mean_abs_surprise_pct DESC"""))
def q_surprise_analysis(spark, sf_dir):
    return R.surprise_analysis(enriched(spark, sf_dir))


@register("surprise_leaderboard", with_base(f"""
SELECT release_name, source,
       count(*) AS n_releases,
       round(avg(abs(surprise_pct)), 2) AS mean_abs_surprise,
       round(max(abs(surprise_pct)), 2) AS max_abs_surprise,
       CAST(sum(CASE WHEN surprise_pct > 0 THEN 1 ELSE 0 END) AS BIGINT) AS beats,
       CAST(sum(CASE WHEN surprise_pct < 0 THEN 1 ELSE 0 END) AS BIGINT) AS misses,
       CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomalies
{_AGG_FILTER}
ORDER BY mean_abs_surprise DESC"""))
def q_surprise_leaderboard(spark, sf_dir):
    return R.surprise_leaderboard(enriched(spark, sf_dir))


@register("latest_by_indicator", with_base(f"""
SELECT indicator, release_name, source, period, value, prior_value, surprise_pct, market_impact,
       value_direction, is_anomaly, {ts('processed_ts')}
FROM (SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY processed_ts DESC, event_id) AS rn
      FROM enr) t
WHERE rn = 1"""))
def q_latest_by_indicator(spark, sf_dir):
    return presentable(R.latest_by_indicator(enriched(spark, sf_dir)))


@register("latest_releases", with_base(f"""
SELECT release_name, indicator, period, value, surprise_pct, market_impact, value_direction,
       is_anomaly, {ts('processed_ts')}
FROM enr ORDER BY processed_ts DESC, event_id LIMIT 20"""))
def q_latest_releases(spark, sf_dir):
    return presentable(R.latest_releases(enriched(spark, sf_dir), n=20))


_HIGH_COLS = ("event_id, source, release_name, indicator, period, value, prior_value, consensus, "
              "revision, surprise_pct, market_impact, value_direction, is_anomaly, anomaly_reason")


@register("high_impact_events", with_base(f"""
SELECT {_HIGH_COLS}, {ts('processed_ts')}, {dt('processing_date')}
FROM enr
WHERE market_impact = 'HIGH'
  AND processing_date >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL {SINCE_DAYS} DAY
ORDER BY processed_ts DESC"""))
def q_high_impact_events(spark, sf_dir):
    df = R.high_impact_events(enriched(spark, sf_dir), since_days=SINCE_DAYS, as_of=AS_OF)
    return presentable(df.select(*[c.strip() for c in _HIGH_COLS.split(",")],
                                 "processed_ts", "processing_date"))


@register("recent_high_impact", with_base(f"""
SELECT release_name, source, indicator, period, value, prior_value, surprise_pct, value_direction,
       anomaly_reason, {ts('processed_ts')}
FROM enr
WHERE market_impact = 'HIGH' AND processed_ts > TIMESTAMP '{AS_OF}' - INTERVAL {SINCE_DAYS} DAY
ORDER BY processed_ts DESC"""))
def q_recent_high_impact(spark, sf_dir):
    return presentable(R.recent_high_impact(enriched(spark, sf_dir), since_days=SINCE_DAYS, as_of=AS_OF))


@register("fomc_decision_history", with_base(f"""
SELECT period, value, prior_value, value_direction, surprise_pct, is_anomaly, {ts('processed_ts')}
FROM enr WHERE release_name = 'FOMC_RATE_DECISION' ORDER BY period"""))
def q_fomc_decision_history(spark, sf_dir):
    return presentable(R.fomc_decision_history(enriched(spark, sf_dir)))


@register("fomc_rate_change", with_base(f"""
SELECT period, value AS fed_funds_rate, prior_value AS prior_rate,
       round(value - coalesce(prior_value, value), 2) + 0.0 AS rate_change_pp,
       round((value - coalesce(prior_value, value)) * 100, 2) + 0.0 AS rate_change_bps,
       value_direction AS direction, surprise_pct, {ts('processed_ts')}
FROM enr WHERE release_name = 'FOMC_RATE_DECISION' ORDER BY period DESC"""))
def q_fomc_rate_change(spark, sf_dir):
    return presentable(R.fomc_rate_change(enriched(spark, sf_dir)))


@register("anomaly_summary", with_base(f"""
SELECT release_name, indicator, period, value, surprise_pct, anomaly_reason, market_impact,
       {ts('processed_ts')}
FROM enr WHERE is_anomaly ORDER BY processed_ts DESC"""))
def q_anomaly_summary(spark, sf_dir):
    return presentable(R.anomaly_summary(enriched(spark, sf_dir)))


@register("freshness", with_base(f"""
SELECT count(*) AS n_rows, {ts('max(processed_ts)', 'last_processed_ts')} FROM enr"""))
def q_freshness(spark, sf_dir):
    return presentable(R.freshness(enriched(spark, sf_dir)))
