"""Micro-batch sinks used by the fan-out.

Every sink but a Kafka topic is idempotent per batch, so a replayed micro-batch
(restart after a failure, at-least-once delivery into ``foreachBatch``) does not
duplicate; a topic may receive a replayed batch's messages twice:

* tables: the batch overwrites its own ``batch_id=N`` directory;
* bus outputs without Kafka: ``batch_id=N`` directories, overwritten;
* serving table: de-duplicated on event_id inside the batch, then anti-joined
  against the keys that the target has had since the batch's earliest time
  (pushed down), then appended. A retry after a partial write only adds the missing rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.functions.payload import alert_messages, enriched_messages, serving_rows
from releaseflow.operators.integrity import UUID_PATTERN
from releaseflow.session import path_exists


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName(  # noqa: SLF001
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


@dataclass
class BusSink:
    """A Kafka topic, or a directory per batch where no bootstrap servers are given.

    Kafka appends: a replayed batch sends its messages again (at least once).
    """

    topic: str
    bootstrap_servers: str | None = None
    fallback_dir: str | None = None

    def write(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        if self.bootstrap_servers:
            if not kafka_available(spark):
                raise RuntimeError(f"{self.topic}: bootstrap servers given, but the Kafka connector is not installed")
            (messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"),
                             *([F.col("headers")] if "headers" in messages.columns else []))
             .write.format("kafka")
             .option("kafka.bootstrap.servers", self.bootstrap_servers)
             .option("topic", self.topic)
             .save())
            return
        if not self.fallback_dir:
            raise ValueError(f"neither bootstrap servers nor a directory for {self.topic}")
        cols = [F.col("key").cast("string"), F.col("value").cast("string")]
        if "headers" in messages.columns:
            cols.append(F.transform("headers", lambda h: F.struct(
                h["key"].alias("key"), h["value"].cast("string").alias("value"))).alias("headers"))
        messages.select(*cols).write.mode("overwrite").json(f"{self.fallback_dir}/batch_id={batch_id}")


def write_alerts(batch: DataFrame, batch_id: int, sink: BusSink) -> None:
    """Anomalies as key ``source:release_name`` + JSON value, with headers."""
    sink.write(alert_messages(batch, with_headers=True), batch_id)


def write_enriched_topic(batch: DataFrame, batch_id: int, sink: BusSink) -> None:
    sink.write(enriched_messages(batch), batch_id)


# -- serving table ------------------------------------------------------------------------

class ServingTarget:
    """Where serving rows go; implementations read existing keys and append.

    ``id_pattern`` is the form that the target's event_id column takes, None for any text.
    """

    id_pattern: str | None = None

    def existing_keys(self, spark: SparkSession, since: datetime) -> DataFrame:
        raise NotImplementedError

    def append(self, rows: DataFrame) -> None:
        raise NotImplementedError


@dataclass
class JdbcServingTarget(ServingTarget):
    """Serving table over JDBC (e.g. PostgreSQL). The key lookup is a query the
    database filters by time, so only recent keys are transferred."""

    url: str
    table: str = "streaming.releases_enriched"
    properties: dict = field(default_factory=dict)

    def __post_init__(self):
        # Let PostgreSQL cast string parameters into its UUID / TIMESTAMPTZ columns.
        if self.url.startswith("jdbc:postgresql:"):
            self.properties.setdefault("stringtype", "unspecified")
            self.id_pattern = UUID_PATTERN

    def existing_keys(self, spark, since):
        q = (f"(SELECT CAST(event_id AS VARCHAR(64)) AS event_id FROM {self.table} "
             f"WHERE processed_ts >= TIMESTAMP '{since:%Y-%m-%d %H:%M:%S}') k")
        return spark.read.jdbc(self.url, q, properties=self.properties)

    def append(self, rows):
        rows.write.jdbc(self.url, self.table, mode="append", properties=self.properties)


@dataclass
class ParquetServingTarget(ServingTarget):
    """Serving rows in a Parquet directory (tests and file-based serving)."""

    path: str

    def existing_keys(self, spark, since):
        if not path_exists(spark, self.path):  # nothing written yet
            return spark.createDataFrame([], "event_id string")
        return spark.read.parquet(self.path).filter(F.col("processed_ts") >= F.lit(since)).select("event_id")

    def append(self, rows):
        rows.write.mode("append").parquet(self.path)


def write_serving(batch: DataFrame, target: ServingTarget) -> DataFrame:
    """Append the batch's serving rows that the target does not hold yet.

    Re-deliveries in later batches never reach here (index of seen events), so the
    only repeats are rows of this batch from an attempt before. Those were
    processed no earlier than the bus received them, whenever the replay comes:
    the batch's earliest bus or processing time bounds the keys to read.
    """
    spark = batch.sparkSession
    rows = serving_rows(batch).dropDuplicates(["event_id"])
    since = batch.agg(F.min(F.least("kafka_ts", "processed_ts"))).first()[0]
    if since is None:
        return rows
    known = target.existing_keys(spark, since)
    fresh = rows.join(known, on="event_id", how="left_anti")
    target.append(fresh)
    return fresh


def quarantined(refused: DataFrame) -> DataFrame:
    """Dead letters of valid rows that the serving table would refuse; ``missing_fields`` names what is wrong."""
    payload = F.col("payload") if "payload" in refused.columns else F.lit(None).cast("string")
    return refused.select("kafka_ts", "partition", "offset", "event_id", payload.alias("payload"),
                          F.lit("constraint").alias("dlq_reason"),
                          F.concat_ws(",", "violations").alias("missing_fields"))


def dead_letter_messages(dlq: DataFrame) -> DataFrame:
    """DLQ records for the bus: key = reason, value = JSON of the record and its raw payload."""
    from releaseflow.functions.payload import json_of
    return dlq.select(F.col("dlq_reason").alias("key"),
                      json_of(["kafka_ts", "partition", "offset", "event_id", "dlq_reason",
                               "missing_fields", "payload"]).alias("value"))


@dataclass
class DeadLetterSink:
    """Per micro-batch: a Parquet folder (overwritten on replay) and, with Kafka, the DLQ topic."""

    path: str
    bus: BusSink | None = None

    def write(self, dlq: DataFrame, batch_id: int) -> None:
        dlq.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if self.bus is not None and self.bus.bootstrap_servers:
            self.bus.write(dead_letter_messages(dlq), batch_id)
