"""Registered queries for parsing, routing, payloads and integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from releaseflow.functions import parse as P
from releaseflow.functions import payload as Y
from releaseflow.operators import history as H
from releaseflow.operators import integrity as G
from releaseflow.plans.common import enriched, presentable, register, releases
from releaseflow.plans.enrichment import ENRICHED_OUT
from releaseflow.plans.oracle import BUS_CTES, json_sql, ts, with_base
from releaseflow.schema import ALERT_COLUMNS, catalog_df
from releaseflow.sources.events import bus_rows, polled_rows

EVENT_OUT = ["event_id", "source", "release_name", "indicator", "period", "value", "prior_value",
             "consensus", "revision", "release_ts", "kafka_ts", "partition", "offset"]
_EVENT_OUT_SQL = ("event_id, source, release_name, indicator, period, value, prior_value, consensus, "
                  f"revision, release_ts, {ts('kafka_ts')}, \"partition\", \"offset\"")


def parsed(spark, sf_dir):
    return P.parse_bus(bus_rows(releases(spark, sf_dir)))


def valid(spark, sf_dir):
    return P.valid_events(parsed(spark, sf_dir))


@register("parse_valid", with_base(f"SELECT {_EVENT_OUT_SQL} FROM valid", BUS_CTES))
def q_parse_valid(spark, sf_dir):
    return presentable(valid(spark, sf_dir).select(*EVENT_OUT))


@register("dlq_events", with_base(f"""
SELECT {ts('kafka_ts')}, "partition", "offset",
       CASE WHEN fault = 'malformed' THEN NULL ELSE event_id END AS event_id,
       CASE WHEN fault = 'malformed' THEN 'malformed_json' ELSE 'missing_field' END AS dlq_reason,
       CASE WHEN fault = 'malformed' THEN NULL ELSE 'indicator' END AS missing_fields
FROM bus WHERE fault <> 'ok'""", BUS_CTES))
def q_dlq_events(spark, sf_dir):
    return presentable(P.dead_letters(parsed(spark, sf_dir)).drop("payload"))


@register("json_roundtrip", with_base("""
SELECT event_id, value, prior_value, consensus, revision, period,
       CAST(12 - (value IS NULL)::INT - (prior_value IS NULL)::INT - (consensus IS NULL)::INT
            - 1 AS BIGINT) AS n_keys
FROM rel"""))
def q_json_roundtrip(spark, sf_dir):
    """Event -> JSON (null keys dropped) -> event; the round trip is lossless."""
    text = P.event_to_json(releases(spark, sf_dir))
    back = releases(spark, sf_dir).select(text.alias("j")).select(
        P.event_from_json(F.col("j")).alias("e"), F.size(F.json_object_keys("j")).cast("long").alias("n_keys"))
    return back.select("e.event_id", "e.value", "e.prior_value", "e.consensus", "e.revision",
                       "e.period", "n_keys")


@register("message_keys", with_base("""
SELECT event_id, source || ':' || release_name AS alert_key,
       source || ':' || release_name || ':' || period AS raw_key
FROM enr"""))
def q_message_keys(spark, sf_dir):
    return enriched(spark, sf_dir).select("event_id", Y.alert_key().alias("alert_key"),
                                          Y.raw_key().alias("raw_key"))


_ALERT_KINDS = {"value": "num", "surprise_pct": "num", "processed_ts": "ts"}


@register("alert_payload", with_base(f"""
SELECT source || ':' || release_name AS key,
       {json_sql([(c, _ALERT_KINDS.get(c, 'str')) for c in ALERT_COLUMNS], keep_nulls=False)} AS value
FROM enr WHERE is_anomaly"""))
def q_alert_payload(spark, sf_dir):
    return Y.alert_messages(enriched(spark, sf_dir))


_ENRICHED_KINDS = {"value": "num", "prior_value": "num", "consensus": "num", "surprise_pct": "num",
                   "revision": "bool", "is_anomaly": "bool", "processed_ts": "ts"}


@register("enriched_payload", with_base(f"""
SELECT source || ':' || release_name || ':' || period AS key,
       {json_sql([(c, _ENRICHED_KINDS.get(c, 'str')) for c in Y.ENRICHED_PAYLOAD_COLUMNS],
                 keep_nulls=True)} AS value
FROM enr"""))
def q_enriched_payload(spark, sf_dir):
    return Y.enriched_messages(enriched(spark, sf_dir)).select("key", "value")


_ENRICHED_OUT_SQL = (
    "event_id, source, release_name, indicator, period, value, prior_value, consensus, revision, "
    "surprise_pct, market_impact, value_direction, is_anomaly, anomaly_reason, "
    f"{ts('processed_ts')}, strftime(processing_date, '%Y-%m-%d') AS processing_date, {ts('kafka_ts')}, "
    "\"partition\", \"offset\", batch_id")


@register("anomaly_table", with_base(f"SELECT {_ENRICHED_OUT_SQL} FROM enr WHERE is_anomaly"))
def q_anomaly_table(spark, sf_dir):
    """Rows the fan-out writes to the anomaly table."""
    return presentable(enriched(spark, sf_dir).filter(F.col("is_anomaly")).select(*ENRICHED_OUT))


@register("catalog_join", with_base("""
SELECT v.event_id, v.release_name, c.indicator, c.source, c.frequency, v."offset"
FROM valid v JOIN cat c ON v.release_name = c.release_name""", BUS_CTES))
def q_catalog_join(spark, sf_dir):
    return (G.with_catalog(valid(spark, sf_dir).select("event_id", "release_name", "offset"),
                           catalog_df(spark))
            .select("event_id", "release_name", "indicator", "source", "frequency", "offset"))


@register("unknown_release", with_base("""
SELECT v.event_id, v.release_name, v."offset"
FROM valid v WHERE v.release_name NOT IN (SELECT release_name FROM cat)""", BUS_CTES))
def q_unknown_release(spark, sf_dir):
    return G.unknown_releases(valid(spark, sf_dir), catalog_df(spark)).select(
        "event_id", "release_name", "offset")


@register("dedup_events", with_base(f"""
SELECT {_EVENT_OUT_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_ts, "partition", "offset") AS rn
  FROM valid) t
WHERE rn = 1""", BUS_CTES))
def q_dedup_events(spark, sf_dir):
    return presentable(G.first_delivery(valid(spark, sf_dir)).select(*EVENT_OUT))


@register("constraint_check", with_base("""
SELECT CAST(sum(c) AS BIGINT) AS n_rows,
       CAST(sum(n_null_event_id) AS BIGINT) AS n_null_event_id,
       CAST(sum(n_null_source) AS BIGINT) AS n_null_source,
       CAST(sum(n_null_release_name) AS BIGINT) AS n_null_release_name,
       CAST(sum(n_null_indicator) AS BIGINT) AS n_null_indicator,
       CAST(sum(n_null_period) AS BIGINT) AS n_null_period,
       CAST(sum(n_too_wide) AS BIGINT) AS n_too_wide,
       CAST(sum(CASE WHEN event_id IS NOT NULL AND c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicate_ids,
       CAST(sum(CASE WHEN event_id IS NOT NULL THEN c - 1 ELSE 0 END) AS BIGINT) AS n_duplicate_rows
FROM (
  SELECT event_id, count(*) AS c,
         sum(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) AS n_null_event_id,
         sum(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_null_source,
         sum(CASE WHEN release_name IS NULL THEN 1 ELSE 0 END) AS n_null_release_name,
         sum(CASE WHEN indicator IS NULL THEN 1 ELSE 0 END) AS n_null_indicator,
         sum(CASE WHEN period IS NULL THEN 1 ELSE 0 END) AS n_null_period,
         sum(CASE WHEN length(source) > 20 OR length(release_name) > 60 OR length(indicator) > 60
                       OR length(period) > 20 THEN 1 ELSE 0 END) AS n_too_wide
  FROM valid GROUP BY event_id) t""", BUS_CTES))
def q_constraint_check(spark, sf_dir):
    return G.constraint_check(valid(spark, sf_dir))


_POLLED_SQL = """
polled AS (
  SELECT seq, event_id, source, release_name, period, release_ts, kafka_ts,
         CASE WHEN seq % 97 = 0 THEN 'n/a' WHEN value IS NULL THEN '.' ELSE CAST(value AS VARCHAR) END AS v
  FROM rel),
obs AS (
  SELECT *, TRY_CAST(nullif(v, '.') AS DOUBLE) AS value, v = '.' AS is_missing,
         v <> '.' AND TRY_CAST(nullif(v, '.') AS DOUBLE) IS NULL AS is_unreadable
  FROM polled)"""


@register("polled_observations", with_base(
    "SELECT event_id, release_name, period, value, is_missing, is_unreadable FROM obs", _POLLED_SQL))
def q_polled_observations(spark, sf_dir):
    """fn11: sentinel and text of polled series."""
    return P.parse_observations(polled_rows(releases(spark, sf_dir))).select(
        "event_id", "release_name", "period", "value", "is_missing", "is_unreadable")


@register("polled_priors", with_base("""
SELECT release_name, period, value, event_id,
       lag(value) OVER (PARTITION BY release_name ORDER BY period) AS prior_value
FROM (SELECT *, row_number() OVER (PARTITION BY release_name, period ORDER BY kafka_ts, seq) AS rn
      FROM obs WHERE value IS NOT NULL) t
WHERE rn = 1""", _POLLED_SQL))
def q_polled_priors(spark, sf_dir):
    """First readable observation of each period of a polled series, with the period's before."""
    polled = P.parse_observations(polled_rows(releases(spark, sf_dir)))
    return H.prior_from_lag(H.first_observations(polled)).select(
        "release_name", "period", "value", "event_id", "prior_value")


@register("generated_event_ids", with_base("""
SELECT event_id AS source_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
       substr(h, 17, 4) || '-' || substr(h, 21, 12) AS event_id
FROM (SELECT event_id, sha256('["' || source || '","' || release_name || '","' || period || '","' || release_ts || '"]')
             AS h FROM rel) t"""))
def q_generated_event_ids(spark, sf_dir):
    """fn13: ids that follow from source, release, period and release time."""
    return releases(spark, sf_dir).select(
        F.col("event_id").alias("source_id"),
        P.generated_event_id("source", "release_name", "period", "release_ts").alias("event_id"))


QUARANTINE_WIDTHS = {"source": 3, "release_name": 16, "indicator": 60, "period": 20}


@register("quarantine_split", with_base("""
SELECT event_id, concat_ws(',', CASE WHEN length(source) > 3 THEN 'wide:source' END,
                           CASE WHEN length(release_name) > 16 THEN 'wide:release_name' END,
                           CASE WHEN NOT regexp_matches(event_id, '[1-9]$') THEN 'form:event_id' END) AS violations
FROM enr"""))
def q_quarantine_split(spark, sf_dir):
    """Rows that tight limits refuse, with the reasons, beside those they take (no reasons)."""
    good, refused = G.quarantine_split(enriched(spark, sf_dir), widths=QUARANTINE_WIDTHS, id_pattern="[1-9]$")
    return good.select("event_id", F.lit("").alias("violations")).unionByName(
        refused.select("event_id", F.concat_ws(",", "violations").alias("violations")))


@register("message_headers", with_base("""
SELECT event_id, 'source=' || source || ';release_name=' || release_name || ';event_id=' || event_id AS headers
FROM enr"""))
def q_message_headers(spark, sf_dir):
    """Headers of the enriched topic's messages."""
    heads = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    rows = Y.enriched_messages(enriched(spark, sf_dir), "event_id")
    return rows.select("event_id", F.array_join(heads, ";").alias("headers"))
