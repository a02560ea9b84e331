"""The streaming job: bus -> parse -> validate -> dedup -> enrich -> sinks.

Differences from a one-query-per-sink layout, on purpose:

* one ``foreachBatch`` fan-out writes the table, the anomaly table, the serving
  table, the alert topic and the enriched topic from one persisted micro-batch:
  the source is read once, every sink sees the same rows and the same
  ``processed_ts`` (the micro-batch clock), and each write is idempotent per
  batch id, so a replay after a failure does not duplicate;
* late records are kept and marked: first deliveries are found against an index
  of seen events, not by stream state that forgets what the watermark passed;
* valid and malformed records go through one de-duplication with different keys
  (event_id for valid records, the bus position for the others, so malformed
  records never merge) and are split inside the fan-out; the dead-letter output
  and per-batch windowed counts are written there too, so the bus is read by a
  single query. Windowed counts are kept up to date by day
  (``operators.monitor.WindowTotals``); an append-mode stateful window query is optional.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from releaseflow.functions.enrich import enrich
from releaseflow.functions.parse import (
    CORRUPT,
    dead_letters,
    is_valid,
    parse_bus,
    type_mismatches,
    valid_events,
    warned,
)
from releaseflow.operators.history import YEAR_US
from releaseflow.operators.integrity import quarantine_split
from releaseflow.operators.monitor import ProgressLog, WindowTotals, windowed_counts
from releaseflow.schema import (
    BUS_SCHEMA,
    TOPIC_ANOMALIES,
    TOPIC_DLQ,
    TOPIC_ENRICHED,
    TOPIC_RAW,
    TRIGGER_INTERVAL,
    WATERMARK_DELAY,
)
from releaseflow.sources.table import VersionedTable
from releaseflow.streaming.dedup import SeenEvents
from releaseflow.streaming.history import StreamingHistory
from releaseflow.streaming.sinks import (
    BusSink,
    DeadLetterSink,
    ServingTarget,
    quarantined,
    write_alerts,
    write_enriched_topic,
    write_serving,
)


# -- sources ------------------------------------------------------------------------------

def kafka_bus(spark: SparkSession, bootstrap_servers: str, topic: str = TOPIC_RAW,
              starting_offsets: str = "earliest",
              max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package). ``earliest`` so nothing
    published before the first start is skipped; the checkpoint decides later. With
    ``fail_on_data_loss=False`` the query goes on where offsets have expired on the bus; the
    progress log counts them as ``offsets_skipped``."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
               "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def file_bus(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Bus rows landed as Parquet files with the Kafka row schema (same contract)."""
    r = spark.readStream.schema(BUS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


# -- transforms -------------------------------------------------------------------------------

DEDUP_KEY = "_dedup_key"

def enriched_stream(bus: DataFrame, watermark: str = WATERMARK_DELAY, dedup: bool = True) -> DataFrame:
    """Valid, enriched events; with ``dedup``, by stream state within the watermark, which
    also drops events later than that. For the optional stateful window query only."""
    valid = valid_events(parse_bus(bus)).withWatermark("kafka_ts", watermark)
    if dedup:
        valid = valid.dropDuplicatesWithinWatermark(["event_id"])
    return enrich(valid)


def routed_stream(bus: DataFrame) -> DataFrame:
    """Every bus record, parsed and enriched, with the key it de-duplicates on.

    Valid records de-duplicate on event_id, all others on their bus position
    (partition, offset), so malformed records never merge with each other while
    a re-read of the same record is still dropped. The fan-out does so against the
    index of seen events (no stream state, so late records are kept) and splits
    the two kinds per micro-batch: the bus is read by one query only.
    """
    parsed = parse_bus(bus)
    key = (F.when(is_valid(), F.concat(F.lit("e:"), F.col("event_id")))
           .otherwise(F.concat_ws(":", F.lit("p"), F.col("partition").cast("string"),
                                  F.col("offset").cast("string"))))
    return enrich(parsed.withColumn(DEDUP_KEY, key))


# -- the fan-out ---------------------------------------------------------------------------------

@dataclass
class FanOut:
    """Per-micro-batch writer of every main-path sink."""

    table: VersionedTable
    anomalies: VersionedTable | None = None
    serving: ServingTarget | None = None
    alerts: BusSink | None = None
    enriched_topic: BusSink | None = None
    history: StreamingHistory | None = None
    history_path: str | None = None
    dead_letters: DeadLetterSink | None = None
    window_partials: str | None = None
    window: str = "1 hour"
    parallel_sinks: int = 4
    seen: SeenEvents | None = None
    written: dict = field(default_factory=dict)
    progress: ProgressLog | None = None
    refused: dict = field(default_factory=dict)  # per batch, rows kept out of the serving table

    def __post_init__(self):
        if self.window_partials is not None:
            self.windows = WindowTotals(self.table.spark, self.window_partials, self.window)
        if self.history is not None and self.history_path:
            self.history.context_path = self.history_path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        arrived = batch.persist()  # parsed once, whatever reads it
        try:
            batch = arrived if self.seen is None else self.seen.fresh(arrived, batch_id).persist()
            if batch.isEmpty():
                return
            tasks = [self.progress.flush] if self.progress is not None else []  # reports of earlier batches
            if self.seen is not None:
                everything = batch
                tasks.append(lambda: self.seen.commit(everything, batch_id))
            routed = "payload" in batch.columns  # then valid rows and dead letters come together
            valid = batch.filter(is_valid()) if routed else batch
            b = valid.drop("payload", CORRUPT, DEDUP_KEY)
            letters = [dead_letters(batch), type_mismatches(batch), warned(batch)] if routed else []
            served = b
            if self.serving is not None:
                # The table keeps every valid row; the serving table only gets what it can take.
                good, refused = quarantine_split(valid, id_pattern=self.serving.id_pattern)
                served = good.drop("payload", CORRUPT, DEDUP_KEY)
                letters.append(quarantined(refused))
            if self.dead_letters is not None and letters:
                dlq = reduce(DataFrame.unionByName, letters)

                def write_letters():
                    refusals = Observation(f"refused_{batch_id}_{uuid.uuid4().hex}")
                    count = F.sum(F.when(F.col("dlq_reason") == "constraint", 1).otherwise(0))
                    self.dead_letters.write(dlq.observe(refusals, count.alias("n")), batch_id)
                    self.refused[batch_id] = int(refusals.get.get("n") or 0)
                tasks.append(write_letters)
            tasks.append(lambda: self.written.__setitem__(batch_id, self.table.write_batch(b, batch_id)))
            if self.anomalies is not None:
                tasks.append(lambda: self.anomalies.write_batch(
                    b.filter(F.col("is_anomaly") == F.lit(True)), batch_id))
            if self.serving is not None:
                tasks.append(lambda: write_serving(served, self.serving))
            if self.alerts is not None:
                tasks.append(lambda: write_alerts(b, batch_id, self.alerts))
            if self.enriched_topic is not None:
                tasks.append(lambda: write_enriched_topic(b, batch_id, self.enriched_topic))
            if self.window_partials is not None:
                tasks.append(lambda: self.windows.add(b, batch_id))
            if self.history is not None:
                def history():
                    rows = b.drop("is_late")
                    self.history.emit(self.history.process(rows, batch_id), batch_id)
                    self.history.commit(rows, batch_id)
                tasks.append(history)
            # The sinks are independent and idempotent: run their jobs concurrently over the
            # persisted batch. Any failure fails the batch, which then replays as a whole.
            self.written.pop(batch_id, None)
            with ThreadPoolExecutor(max_workers=max(1, self.parallel_sinks)) as pool:
                for f in [pool.submit(t) for t in tasks]:
                    f.result()
        finally:
            batch.unpersist()
            arrived.unpersist()


@dataclass
class StreamConfig:
    root: str                      # shared folder for tables and outputs
    checkpoint_root: str           # shared folder for the query checkpoints
    trigger: dict = field(default_factory=lambda: {"processingTime": TRIGGER_INTERVAL})
    watermark: str = WATERMARK_DELAY
    window: str = "1 hour"
    bootstrap_servers: str | None = None
    serving: ServingTarget | None = None
    history_window_us: int | None = YEAR_US   # None: no rolling context in the stream
    window_query: bool = False   # also run append-mode windowed counts as a stateful query


def start(spark: SparkSession, bus: DataFrame, cfg: StreamConfig) -> dict:
    """Start the fan-out query (one read of the bus); optionally the stateful window query.

    Returns ``{"main", "queries", "fanout", "listener"}``; the listener notes each batch's progress
    until ``spark.streams.removeListener``, and its ``flush`` writes what the last batches reported.
    """
    root = cfg.root.rstrip("/")
    fan = FanOut(
        table=VersionedTable(spark, f"{root}/releases_enriched"),
        anomalies=VersionedTable(spark, f"{root}/anomalies"),
        serving=cfg.serving,
        alerts=BusSink(TOPIC_ANOMALIES, cfg.bootstrap_servers, f"{root}/bus/anomalies"),
        enriched_topic=BusSink(TOPIC_ENRICHED, cfg.bootstrap_servers, f"{root}/bus/enriched"),
        history=(StreamingHistory(spark, f"{root}/_history_state", cfg.history_window_us)
                 if cfg.history_window_us else None),
        history_path=f"{root}/history_context",
        dead_letters=DeadLetterSink(f"{root}/dlq", BusSink(TOPIC_DLQ, cfg.bootstrap_servers)),
        window_partials=f"{root}/window_partials",
        window=cfg.window,
        seen=SeenEvents(spark, f"{root}/_seen_events", DEDUP_KEY, cfg.watermark),
    )
    log = ProgressLog(spark, f"{root}/progress", ("releases_main", "releases_windows"))
    spark.streams.addListener(log)
    fan.progress = log
    main = (routed_stream(bus).writeStream
            .queryName("releases_main")
            .option("checkpointLocation", f"{cfg.checkpoint_root}/releases_main")
            .trigger(**cfg.trigger)
            .foreachBatch(fan)
            .start())
    queries = [main]
    if cfg.window_query:
        queries.append(
            windowed_counts(enriched_stream(bus, cfg.watermark), cfg.window)
            .writeStream.queryName("releases_windows")
            .format("parquet").outputMode("append")
            .option("path", f"{root}/windowed_counts")
            .option("checkpointLocation", f"{cfg.checkpoint_root}/releases_windows")
            .trigger(**cfg.trigger)
            .start())
    log.ids = {q.id for q in queries}
    return {"main": main, "queries": queries, "fanout": fan, "listener": log}
