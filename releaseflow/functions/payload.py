"""Message keys, headers and JSON payloads for bus sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.schema import ALERT_COLUMNS, SERVING_COLUMNS

# Timestamps in payloads: ISO-8601 with microseconds and offset (Z under UTC).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def alert_key() -> Column:
    """``source:release_name`` (null when either part is null, like ``concat``)."""
    return F.concat(F.col("source"), F.lit(":"), F.col("release_name"))


def raw_key() -> Column:
    """``source:release_name:period``: the producer's partitioning key."""
    return F.concat(F.col("source"), F.lit(":"), F.col("release_name"), F.lit(":"), F.col("period"))


def headers() -> Column:
    """Kafka ``headers`` column: array<struct<key string, value binary>>."""
    return F.array(*[F.struct(F.lit(h).alias("key"), F.col(h).cast("binary").alias("value"))
                     for h in ("source", "release_name", "event_id")])


def json_of(cols: list[str], ignore_null_fields: bool = True) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]),
                     {"timestampFormat": JSON_TS_FORMAT,
                      "ignoreNullFields": str(ignore_null_fields).lower()})


def alert_messages(enriched: DataFrame, with_headers: bool = False) -> DataFrame:
    """Anomalies as (key, value[, headers]) bus messages; null fields are left out of the JSON."""
    cols = [alert_key().alias("key"), json_of(ALERT_COLUMNS).alias("value")]
    if with_headers:
        cols.append(headers().alias("headers"))
    return enriched.filter(F.col("is_anomaly") == F.lit(True)).select(*cols)


ENRICHED_PAYLOAD_COLUMNS = [
    "event_id", "source", "release_name", "indicator", "period", "value", "prior_value",
    "consensus", "surprise_pct", "revision", "market_impact", "value_direction", "is_anomaly",
    "anomaly_reason", "release_ts", "processed_ts",
]


def enriched_messages(enriched: DataFrame, *more: str) -> DataFrame:
    """Every enriched event for the enriched topic, with headers; nulls kept as JSON null."""
    return enriched.select(raw_key().alias("key"),
                           json_of(ENRICHED_PAYLOAD_COLUMNS, ignore_null_fields=False).alias("value"),
                           headers().alias("headers"), *more)


def serving_rows(df: DataFrame) -> DataFrame:
    """The 16-column serving row; release_ts is parsed to a timestamp in Spark
    (bad text becomes null instead of failing the database write)."""
    return df.select(*[
        F.expr("try_to_timestamp(release_ts)").alias("release_ts") if c == "release_ts" else F.col(c)
        for c in SERVING_COLUMNS])
