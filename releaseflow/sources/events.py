"""Adapter from the generic ``events`` table to release events and bus rows.

The test tables hold generic click-stream ``events`` (event_id, ts, user_id,
event_type, value, props ``{"k": n}``). Every registered query derives its
release events from them with the fixed rules below, so the work grows with
the table. Rules (k = props.k):

* release_name = catalog row ``pmod(user_id, 13)``; indicator and source from the catalog
* event_id = string of the numeric id; kafka_ts = ts
* value = null when id % 50 = 0, negated when id % 11 = 0
* prior_value = null when k % 5 = 0, the value itself when k % 5 = 1,
  else the previous value of the same release (by ts, id)
* consensus = 0 when k = 0, null when k = 1,
  else floor(value * (200 + k) / 250 * 100) / 100
* revision = (event_type = 'error'); period = yyyy-MM-dd of ts
* partition = id % 3; offset = id div 3; release_ts = ingested_ts = ISO text of ts

Polled rows carry the value as text: "." where it is null, "n/a" when id % 97 = 0, else the
number, within blanks when id % 7 = 0.

Bus rows additionally carry faults: a malformed payload when id % 101 = 0,
a missing indicator when id % 103 = 0, a release name outside the catalog
(lower-cased) when id % 109 = 0, and a duplicate delivery when id % 20 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.operators.sequence import DEFAULT_BUCKET_SECONDS, bucketed_lag
from releaseflow.schema import RELEASE_CATALOG, TOPIC_RAW

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _catalog_lookup(idx: Column) -> tuple[Column, Column, Column]:
    """Catalog as literal arrays: an index lookup inside codegen, no join."""
    names = F.array(*[F.lit(r[0]) for r in RELEASE_CATALOG])
    indicators = F.array(*[F.lit(r[1]) for r in RELEASE_CATALOG])
    sources = F.array(*[F.lit(r[2]) for r in RELEASE_CATALOG])
    pos = (idx + 1).cast("int")
    return F.element_at(names, pos), F.element_at(indicators, pos), F.element_at(sources, pos)


def release_events(events: DataFrame, lag_bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Release events (payload fields + kafka_ts, partition, offset, seq)."""
    eid = F.col("event_id")
    # props is JSON: parse it once. The one-element inline makes k a generator
    # output, so predicates on values derived from k are not pushed below it
    # with the JSON parse copied into every conjunct.
    events = events.select("*", F.inline(F.array(F.struct(
        F.get_json_object("props", "$.k").try_cast("int").alias("_k")))))
    k = F.col("_k")
    release_name, indicator, source = _catalog_lookup(F.pmod(F.col("user_id"), F.lit(13)))
    kafka_ts = F.col("ts").cast("timestamp")
    value = (F.when(eid % 50 == 0, F.lit(None).cast("double"))
             .when(eid % 11 == 0, -F.col("value"))
             .otherwise(F.col("value")))
    base = events.select(
        eid.alias("seq"),
        eid.cast("string").alias("event_id"),
        source.alias("source"),
        release_name.alias("release_name"),
        indicator.alias("indicator"),
        F.date_format(kafka_ts, "yyyy-MM-dd").alias("period"),
        value.alias("value"),
        (F.col("event_type") == "error").alias("revision"),
        k.alias("_k"),
        F.date_format(kafka_ts, ISO_FORMAT).alias("release_ts"),
        F.date_format(kafka_ts, ISO_FORMAT).alias("ingested_ts"),
        kafka_ts.alias("kafka_ts"),
        (eid % 3).cast("int").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
    )
    with_lag = bucketed_lag(base, ["release_name"], "kafka_ts", ["seq"], ["value"], ["_prev"],
                            bucket_seconds=lag_bucket_seconds)
    kk = F.col("_k")
    v = F.col("value")
    prior = (F.when(kk % 5 == 0, F.lit(None).cast("double"))
             .when(kk % 5 == 1, v)
             .otherwise(F.col("_prev")))
    consensus = (F.when(kk == 0, F.lit(0.0))
                 .when(kk == 1, F.lit(None).cast("double"))
                 .otherwise(F.floor(v * (F.lit(200) + kk) / F.lit(250.0) * F.lit(100.0)) / F.lit(100.0)))
    return with_lag.select(
        "seq", "event_id", "source", "release_name", "indicator", "period", "value",
        prior.alias("prior_value"),
        F.lit(None).cast("double").alias("surprise_pct"),
        "revision",
        consensus.cast("double").alias("consensus"),
        "release_ts", "ingested_ts", "kafka_ts", "partition", "offset",
    )


def bus_rows(releases: DataFrame, topic: str = TOPIC_RAW) -> DataFrame:
    """Kafka-shaped rows (key, value, topic, partition, offset, timestamp) with faults."""
    seq = F.col("seq")
    releases = releases.withColumn(
        "release_name", F.when(seq % 109 == 0, F.lower("release_name")).otherwise(F.col("release_name")))
    payload = F.to_json(F.struct(*[F.col(c) for c in (
        "event_id", "source", "release_name", "indicator", "period", "value", "prior_value",
        "surprise_pct", "revision", "consensus", "release_ts", "ingested_ts")]))
    missing_indicator = F.to_json(F.struct(*[F.col(c) for c in (
        "event_id", "source", "release_name", "period", "value", "prior_value",
        "revision", "consensus", "release_ts", "ingested_ts")]))
    value = (F.when(seq % 101 == 0, F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","source":')))
             .when(seq % 103 == 0, missing_indicator)
             .otherwise(payload))
    key = F.concat(F.col("source"), F.lit(":"), F.col("release_name"), F.lit(":"), F.col("period"))
    # Duplicate deliveries: the same record re-sent at a later offset. One pass
    # (explode), so the adapter's shuffles are not run a second time for the copies.
    copies = F.explode(F.when(seq % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (releases.select("*", copies.alias("_copy"))
            .select("seq",
                    key.cast("binary").alias("key"),
                    value.cast("binary").alias("value"),
                    F.lit(topic).alias("topic"),
                    "partition",
                    (F.col("offset") + F.col("_copy") * F.lit(1 << 40)).alias("offset"),
                    F.col("kafka_ts").alias("timestamp")))


def polled_rows(releases: DataFrame) -> DataFrame:
    """Observations as a polled series gives them: release, period and the value as text."""
    seq, number = F.col("seq"), F.col("value").cast("string")
    text = (F.when(seq % 97 == 0, F.lit("n/a")).when(number.isNull(), F.lit("."))
            .when(seq % 7 == 0, F.concat(F.lit("  "), number, F.lit(" "))).otherwise(number))
    return releases.select("seq", "event_id", "source", "release_name", "period", "release_ts", "kafka_ts",
                           text.alias("value_text"))
