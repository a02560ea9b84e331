"""Windowed counts and consumer-lag monitoring."""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from releaseflow.schema import LAG_ALERT_THRESHOLD
from releaseflow.sources.versions import VersionedBuckets, newest_versions


def windowed_counts(enriched: DataFrame, window: str = "1 hour", ts_col: str = "kafka_ts") -> DataFrame:
    """Tumbling-window counts per source. The same code runs on a stream (after a
    watermark, append mode emits each window once it is final) and on a table."""
    def count_if(c):
        return F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("long")
    return (enriched.groupBy(F.window(F.col(ts_col), window).alias("w"), F.col("source"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 count_if(F.col("is_anomaly")).alias("n_anomalies"),
                 count_if(F.col("market_impact") == "HIGH").alias("n_high_impact"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "source", "n_events", "n_anomalies", "n_high_impact"))


_COUNTS = ("n_events", "n_anomalies", "n_high_impact")


def _added(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in _COUNTS])


@dataclass
class WindowTotals:
    """Windowed counts kept up to date batch by batch.

    The counts of all windows that begin on one day are one bucket. A batch adds its own
    counts to the buckets of its rows' days, late ones too, and writes them as their next version: a
    closed day is one small file, however many batches made it.
    """

    spark: SparkSession
    path: str
    window: str = "1 hour"

    def __post_init__(self):
        self.store = VersionedBuckets(self.spark, self.path)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        counts = windowed_counts(batch.filter(F.col("kafka_ts").isNotNull()), self.window).withColumn(
            "bucket", F.unix_date(F.to_date("window_start")).cast("long")).persist()
        try:
            days = sorted(r[0] for r in counts.select("bucket").distinct().collect())
            if not days:
                return
            before = self.store.read(days, batch_id)
            both = counts if before is None else counts.unionByName(before)
            self.store.write(_added(both, "bucket", "window_start", "window_end", "source"), days, batch_id)
        finally:
            counts.unpersist()


def windowed_counts_from_partials(spark: SparkSession, path: str) -> DataFrame:
    """Windowed counts as the fan-out's ``WindowTotals`` left them."""
    return newest_versions(spark, path).drop("bucket")


def offset_lag(source_offsets: DataFrame, consumed: DataFrame,
               threshold: int = LAG_ALERT_THRESHOLD) -> DataFrame:
    """Per bus partition: end offset, committed offset, lag; plus the total and the
    alert flag (total > threshold). Both inputs are reduced to one row per
    partition before they meet, so the final window sees only a handful of rows."""
    end = source_offsets.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))
    done = consumed.groupBy("partition").agg((F.max("offset") + 1).alias("committed_offset"))
    lag = (end.join(done, "partition", "left")
              .select("partition", "end_offset",
                      F.coalesce(F.col("committed_offset"), F.lit(0)).cast("long").alias("committed_offset")))
    lag = lag.withColumn("lag", F.col("end_offset") - F.col("committed_offset"))
    total = F.sum("lag").over(Window.partitionBy(F.lit(1)))
    return lag.select("*", total.cast("long").alias("total_lag"), (total > threshold).alias("alert"))


def lag_rows(progress: dict) -> list[tuple]:
    """``(topic, partition, latest offset, end offset, lag)`` of a progress report's bus sources."""
    rows = []
    for src in progress.get("sources", []):
        done = _offsets(src.get("endOffset"))
        for (topic, part), last in _offsets(src.get("latestOffset")).items():
            rows.append((topic, int(part), last, done.get((topic, part), 0), last - done.get((topic, part), 0)))
    return rows


def dropped_rows(progress: dict) -> list[tuple]:
    """``(batch, operator, rows that the watermark dropped, rows of state)`` of a progress report."""
    return [(int(progress.get("batchId", -1)), op.get("operatorName"), int(op.get("numRowsDroppedByWatermark", 0)),
             int(op.get("numRowsTotal", 0))) for op in progress.get("stateOperators", []) or []]


def _read(progress: dict | str | None) -> dict:
    return json.loads(progress) if isinstance(progress, str) else progress or {}


def progress_lag(spark: SparkSession, progress: dict | str | None) -> DataFrame:
    """Lag per topic-partition from one streaming progress report (Kafka sources
    report ``endOffset`` and ``latestOffset`` as {topic: {partition: offset}})."""
    return spark.createDataFrame(
        lag_rows(_read(progress)), "topic string, partition int, latest_offset long, end_offset long, lag long")


def watermark_drops(spark: SparkSession, progresses: list) -> DataFrame:
    """Rows dropped by the watermark per micro-batch and stateful operator, from a
    query's ``recentProgress`` (late records are counted, not silently lost)."""
    return spark.createDataFrame(
        [r for p in progresses or [] for r in dropped_rows(_read(p))],
        "batch_id long, operator string, rows_dropped_by_watermark long, state_rows long")


class ProgressLog(StreamingQueryListener):
    """Keeps what each micro-batch reports: input rows and rate, lag per bus partition, rows that a watermark dropped.

    A listener must not run Spark jobs (queries wait for it), so reports are noted as they come and written by
    ``flush``, which the fan-out calls with every batch and the caller once more at the end. ``batch_progress`` reads
    them. With ``queries``, only of queries of those names; with ``ids``, only of queries with those ids.
    """

    def __init__(self, spark: SparkSession, path: str, queries: tuple[str, ...] = (),
                 threshold: int = LAG_ALERT_THRESHOLD):
        self.spark, self.path, self.queries, self.threshold = spark, path.rstrip("/"), queries, threshold
        self.ids: set[str] = set()
        self.noted: deque[tuple] = deque()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(json.loads(event.progress.json))

    def record(self, progress: dict) -> None:
        """Note one progress report."""
        if (self.queries and progress.get("name") not in self.queries) or (
                self.ids and progress.get("id") not in self.ids):
            return
        lags = [r[-1] for r in lag_rows(progress)]
        dropped = sum(r[2] for r in dropped_rows(progress))
        rows = int(progress.get("numInputRows", 0))
        self.noted.append((progress.get("timestamp"), rows, float(progress.get("processedRowsPerSecond") or 0),
                           sum(lags), len(lags), sum(lags) > self.threshold, dropped,
                           max(0, offsets_passed(progress) - rows), progress.get("name"),
                           int(progress.get("batchId", -1))))

    def flush(self) -> None:
        """Write what has been noted, one folder per query and batch."""
        rows = [self.noted.popleft() for _ in range(len(self.noted))]
        if rows:
            df = self.spark.createDataFrame(rows, f"{PROGRESS_SCHEMA}, query string, batch_id long").coalesce(1)
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("query", "batch_id").json(self.path))


PROGRESS_SCHEMA = ("at string, input_rows long, rows_per_second double, lag long, bus_partitions long, alert boolean, "
                   "rows_dropped_by_watermark long, offsets_skipped long")


def _offsets(text) -> dict[tuple[str, str], int]:
    """``(topic, partition) -> offset`` of a bus source's offset report; empty for other sources."""
    try:
        report = json.loads(text) if isinstance(text, str) else text
    except ValueError:
        return {}
    if not isinstance(report, dict):
        return {}
    return {(topic, part): int(off) for topic, parts in report.items() if isinstance(parts, dict)
            for part, off in parts.items()}


def offsets_passed(progress: dict) -> int:
    """Bus offsets between a batch's start and end: more than its rows if some had expired on the bus."""
    total = 0
    for src in progress.get("sources", []):
        first, end = _offsets(src.get("startOffset")), _offsets(src.get("endOffset"))
        total += sum(max(0, off - first[k]) for k, off in end.items() if k in first)
    return total


def batch_progress(spark: SparkSession, path: str) -> DataFrame:
    """What ``ProgressLog`` wrote, one row per query and batch."""
    return spark.read.schema(f"{PROGRESS_SCHEMA}, query string, batch_id long").json(path)
