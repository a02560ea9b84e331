"""Shared plumbing for registered queries: inputs and output rendering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releaseflow.functions.enrich import enrich
from releaseflow.session import ensure_utc
from releaseflow.sources.events import read_table, release_events

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Report parameters used for the registered queries (the test data spans January 2024).
AS_OF = "2024-01-31 00:00:00"
SINCE_DAYS = 7
BATCH_SIZE = 1000


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return release_events(read_table(spark, sf_dir, "events"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows as the streaming job writes them, with the bus time as clock
    and batch_id = seq div 1000 (one micro-batch per 1,000 offsets)."""
    return (enrich(releases(spark, sf_dir), clock=F.col("kafka_ts"))
            .withColumn("batch_id", F.expr(f"seq div {BATCH_SIZE}")))


def presentable(df: DataFrame) -> DataFrame:
    """Render timestamps and dates as text so engines compare by value."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
