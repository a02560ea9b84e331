"""Registered queries for history-aware operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from releaseflow.operators import history as H
from releaseflow.operators.rolling import DAY_US
from releaseflow.plans.common import enriched, presentable, register, releases
from releaseflow.plans.oracle import calendar_values_sql, with_base
from releaseflow.plans.table import AS_OF_VERSION, release_table
from releaseflow.schema import calendar_df, catalog_df

# The test data spans one month, so the "12-month" window is scaled to 7 days.
WINDOW_DAYS = 7
WINDOW_US = WINDOW_DAYS * DAY_US
WINDOW_SQL = (f"PARTITION BY indicator ORDER BY epoch_us(kafka_ts) "
              f"RANGE BETWEEN {WINDOW_US} PRECEDING AND 1 PRECEDING")
ROWS_SQL = "PARTITION BY indicator ORDER BY kafka_ts, event_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING"


@register("hist_context", with_base(f"""
SELECT event_id, indicator, value,
       CAST(count(value) OVER w AS BIGINT) AS hist_n,
       CASE WHEN count(value) OVER w > 0 THEN
         CAST(sum(CAST(value AS DECIMAL(38, 9))) OVER w AS DOUBLE) / count(value) OVER w END AS hist_mean,
       min(value) OVER w AS hist_min,
       max(value) OVER w AS hist_max
FROM enr WINDOW w AS ({WINDOW_SQL})"""))
def q_hist_context(spark, sf_dir):
    df = H.hist_context(enriched(spark, sf_dir), window_us=WINDOW_US)
    return df.select("event_id", "indicator", "value", "hist_n", "hist_mean", "hist_min", "hist_max")


def _zscore_sql(window: str) -> str:
    return with_base(f"""
SELECT event_id, indicator, value, hist_n,
       m AS hist_mean,
       round(sd, 6) + 0.0 AS hist_std,
       round(z, 4) + 0.0 AS zscore,
       coalesce(abs(z) > 2, false) AS is_zscore_anomaly
FROM (
  SELECT *, CASE WHEN hist_n >= 2 AND sd > 0 THEN (value - m) / sd END AS z
  FROM (
    SELECT event_id, indicator, value,
           CAST(count(value) OVER w AS BIGINT) AS hist_n,
           CASE WHEN count(value) OVER w > 0 THEN
             CAST(sum(CAST(value AS DECIMAL(38, 9))) OVER w AS DOUBLE) / count(value) OVER w END AS m,
           stddev_samp(value) OVER w AS sd
    FROM enr WINDOW w AS ({window})) a) b""")


_Z_OUT = ["event_id", "indicator", "value", "hist_n", "hist_mean", "hist_std", "zscore", "is_zscore_anomaly"]


@register("rolling_zscore", _zscore_sql(WINDOW_SQL))
def q_rolling_zscore(spark, sf_dir):
    return H.rolling_zscore(enriched(spark, sf_dir), window_us=WINDOW_US).select(*_Z_OUT)


@register("rolling_zscore_12obs", _zscore_sql(ROWS_SQL))
def q_rolling_zscore_12obs(spark, sf_dir):
    return H.rolling_zscore_obs(enriched(spark, sf_dir), n_obs=12).select(*_Z_OUT)


_OBS_CTES = """
obs AS (
  SELECT release_name, period, value, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY release_name, period ORDER BY kafka_ts, seq) AS rn
    FROM rel WHERE value IS NOT NULL) t
  WHERE rn = 1
),
lagged AS (
  SELECT *, lag(value) OVER (PARTITION BY release_name ORDER BY period) AS prior_value FROM obs
)"""


@register("prior_from_lag", with_base(
    "SELECT release_name, period, value, event_id, prior_value FROM lagged", _OBS_CTES))
def q_prior_from_lag(spark, sf_dir):
    return H.prior_from_lag(H.first_observations(releases(spark, sf_dir))).select(
        "release_name", "period", "value", "event_id", "prior_value")


@register("new_observations", with_base(f"""
SELECT l.release_name, l.period, l.value, l.event_id, l.prior_value FROM lagged l
WHERE NOT EXISTS (SELECT 1 FROM enr e WHERE e.batch_id <= {AS_OF_VERSION}
                  AND e.release_name = l.release_name AND e.period = l.period)""", _OBS_CTES))
def q_new_observations(spark, sf_dir):
    """Incremental publish after version 3: observations not yet in the table."""
    known = release_table(spark, sf_dir).as_of_version(AS_OF_VERSION)
    obs = H.prior_from_lag(H.first_observations(releases(spark, sf_dir)))
    return H.new_observations(obs, known).select("release_name", "period", "value", "event_id", "prior_value")


@register("revision_vintages", with_base("""
SELECT f.indicator, f.period, f.n AS n_vintages, f.value AS first_value, l.value AS latest_value,
       f.release_name AS first_release, l.release_name AS latest_release,
       round(l.value - f.value, 6) + 0.0 AS revision_delta
FROM (SELECT indicator, period, value, release_name,
             CAST(count(*) OVER (PARTITION BY indicator, period) AS BIGINT) AS n,
             row_number() OVER (PARTITION BY indicator, period ORDER BY release_ts, coalesce(revision, false), event_id) AS rn
      FROM rel) f
JOIN (SELECT indicator, period, value, release_name,
             row_number() OVER (PARTITION BY indicator, period ORDER BY release_ts DESC, coalesce(revision, false) DESC, event_id DESC) AS rn
      FROM rel) l
  ON f.indicator = l.indicator AND f.period = l.period AND f.rn = 1 AND l.rn = 1"""))
def q_revision_vintages(spark, sf_dir):
    return H.revision_vintages(releases(spark, sf_dir))


@register("calendar_events", with_base("""
SELECT d.release_name, strftime(d.release_date, '%Y-%m-%d') AS release_date,
       strftime(d.release_date, '%Y-%m') AS period, c.source, c.indicator, c.frequency, d.n_events,
       CAST(d.release_date - lag(d.release_date) OVER (PARTITION BY d.release_name ORDER BY d.release_date)
            AS BIGINT) AS gap_days,
       k.expected_value, k.release_name IS NOT NULL AS scheduled
FROM days d
LEFT JOIN calendar k ON k.release_name = d.release_name AND k.release_date = d.release_date
LEFT JOIN cat c ON c.release_name = d.release_name""",
    "days AS (SELECT release_name, CAST(kafka_ts AS DATE) AS release_date, count(*) AS n_events "
    "FROM rel GROUP BY 1, 2),\n" + calendar_values_sql()))
def q_calendar_events(spark, sf_dir):
    return presentable(H.calendar_events(releases(spark, sf_dir), calendar_df(spark), catalog_df(spark)))


@register("prior_as_known", with_base("""
SELECT e.event_id, e.release_name, e.period, e.value, e.prior_period, v.value AS prior_known,
       v.vintage AS prior_vintage, v.event_id AS prior_event_id
FROM ev2 e ASOF LEFT JOIN vint v
  ON e.release_name = v.release_name AND e.prior_period = v.period AND e.kafka_ts >= v.kafka_ts""", """
per AS (
  SELECT release_name, period, lag(period) OVER (PARTITION BY release_name ORDER BY period) AS prior_period
  FROM (SELECT DISTINCT release_name, period FROM rel) t),
ev2 AS (SELECT rel.*, per.prior_period FROM rel JOIN per USING (release_name, period)),
vint AS (
  SELECT *, row_number() OVER (PARTITION BY release_name, period ORDER BY kafka_ts) AS vintage FROM (
    SELECT release_name, period, kafka_ts, arg_max(value, seq) AS value, arg_max(event_id, seq) AS event_id
    FROM rel WHERE value IS NOT NULL GROUP BY 1, 2, 3) t)"""))
def q_prior_as_known(spark, sf_dir):
    return H.prior_as_known(releases(spark, sf_dir)).select(
        "event_id", "release_name", "period", "value", "prior_period", "prior_known",
        F.col("prior_vintage").cast("long").alias("prior_vintage"), "prior_event_id")


TOLERANCE_DAYS = 3


@register("schedule_match", with_base(f"""
SELECT release_name, strftime(release_date, '%Y-%m-%d') AS release_date, n_events,
       strftime(matched_date, '%Y-%m-%d') AS matched_date, days_off, expected_value
FROM (
  SELECT d.*, k.release_date AS matched_date, k.expected_value,
         CAST(d.release_date - k.release_date AS BIGINT) AS days_off,
         row_number() OVER (PARTITION BY d.release_name, d.release_date
                            ORDER BY abs(d.release_date - k.release_date), k.release_date) AS rn
  FROM days d LEFT JOIN calendar k ON k.release_name = d.release_name
    AND abs(d.release_date - k.release_date) <= {TOLERANCE_DAYS}) t
WHERE rn = 1""",
    "days AS (SELECT release_name, CAST(kafka_ts AS DATE) AS release_date, count(*) AS n_events "
    "FROM rel GROUP BY 1, 2),\n" + calendar_values_sql()))
def q_schedule_match(spark, sf_dir):
    """Days with events, each with the nearest scheduled date within a few days."""
    days = H.release_days(releases(spark, sf_dir))
    out = H.match_schedule(days, calendar_df(spark), TOLERANCE_DAYS)
    return presentable(out.withColumn("days_off", F.col("days_off").cast("long")))
