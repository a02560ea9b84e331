"""Registered queries for the enrichment projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from releaseflow.plans.common import enriched, presentable, register, releases
from releaseflow.plans.oracle import dt, ts, with_base
from releaseflow.functions import enrich as E
from releaseflow.functions.payload import serving_rows


@register("surprise_pct", with_base(
    "SELECT event_id, value, consensus, surprise_pct FROM s1"))
def q_surprise_pct(spark, sf_dir):
    return (releases(spark, sf_dir).transform(E.add_surprise_pct)
            .select("event_id", "value", "consensus", "surprise_pct"))


@register("market_impact", with_base(
    "SELECT event_id, release_name, revision, surprise_pct, market_impact FROM enr"))
def q_market_impact(spark, sf_dir):
    return (releases(spark, sf_dir).transform(E.add_surprise_pct).transform(E.add_market_impact)
            .select("event_id", "release_name", "revision", "surprise_pct", "market_impact"))


@register("value_direction", with_base(
    "SELECT event_id, value, prior_value, value_direction FROM enr"))
def q_value_direction(spark, sf_dir):
    return (releases(spark, sf_dir).transform(E.add_value_direction)
            .select("event_id", "value", "prior_value", "value_direction"))


@register("flag_anomalies", with_base(
    "SELECT event_id, value, surprise_pct, is_anomaly, anomaly_reason FROM enr"))
def q_flag_anomalies(spark, sf_dir):
    return (releases(spark, sf_dir).transform(E.add_surprise_pct).transform(E.flag_anomalies)
            .select("event_id", "value", "surprise_pct", "is_anomaly", "anomaly_reason"))


@register("processing_meta", with_base(
    f"SELECT event_id, {ts('processed_ts')}, {dt('processing_date')} FROM enr"))
def q_processing_meta(spark, sf_dir):
    df = E.add_processing_metadata(releases(spark, sf_dir), clock=F.col("kafka_ts"))
    return presentable(df.select("event_id", "processed_ts", "processing_date"))


ENRICHED_OUT = ["event_id", "source", "release_name", "indicator", "period", "value", "prior_value",
                "consensus", "revision", "surprise_pct", "market_impact", "value_direction",
                "is_anomaly", "anomaly_reason", "processed_ts", "processing_date",
                "kafka_ts", "partition", "offset", "batch_id"]


@register("enrich_full", with_base(
    "SELECT event_id, source, release_name, indicator, period, value, prior_value, consensus, "
    "revision, surprise_pct, market_impact, value_direction, is_anomaly, anomaly_reason, "
    f"{ts('processed_ts')}, {dt('processing_date')}, {ts('kafka_ts')}, \"partition\", \"offset\", "
    "batch_id FROM enr"))
def q_enrich_full(spark, sf_dir):
    return presentable(enriched(spark, sf_dir).select(*ENRICHED_OUT))


@register("serving_projection", with_base(
    "SELECT event_id, source, release_name, indicator, period, value, prior_value, surprise_pct, "
    "consensus, market_impact, value_direction, is_anomaly, anomaly_reason, revision, "
    f"{ts('kafka_ts', 'release_ts')}, {ts('processed_ts')} FROM enr"))
def q_serving_projection(spark, sf_dir):
    return presentable(serving_rows(enriched(spark, sf_dir)))
