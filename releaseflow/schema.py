"""Schemas and fixed reference values of the release-event data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Must equal the original application's for identical results.
# ---------------------------------------------------------------------------

# Topic names of the event bus.
TOPIC_RAW = "econ.releases.raw"
TOPIC_ENRICHED = "econ.releases.enriched"
TOPIC_ANOMALIES = "econ.releases.anomalies"
TOPIC_DLQ = "econ.releases.dlq"

# Release catalog: release_name, indicator, source, frequency.
RELEASE_CATALOG = [
    ("BEA_GDP_ADVANCE", "gdp_qoq_pct", "BEA", "quarterly"),
    ("BEA_GDP_SECOND", "gdp_qoq_pct", "BEA", "quarterly"),
    ("BEA_GDP_THIRD", "gdp_qoq_pct", "BEA", "quarterly"),
    ("BEA_PCE", "pce_mom_pct", "BEA", "monthly"),
    ("BEA_PERSONAL_INCOME", "personal_income_mom", "BEA", "monthly"),
    ("FOMC_RATE_DECISION", "fed_funds_rate", "FRED", "6-weekly"),
    ("FRED_CPI", "cpi_yoy_pct", "FRED", "monthly"),
    ("FRED_CORE_PCE", "core_pce_yoy_pct", "FRED", "monthly"),
    ("FRED_M2", "m2_money_supply_billions", "FRED", "weekly"),
    ("BLS_JOBS_REPORT", "nonfarm_payrolls_thousands", "BLS", "monthly"),
    ("BLS_UNEMPLOYMENT", "unemployment_rate", "BLS", "monthly"),
    ("BLS_CPI_DETAIL", "cpi_all_urban", "BLS", "monthly"),
    ("BLS_PPI", "ppi_final_demand", "BLS", "monthly"),
]

# 2024 release calendar: release date, release name, expected value (None = unknown).
RELEASE_CALENDAR_2024 = [
    ("2024-01-05", "BLS_JOBS_REPORT", 216.0),
    ("2024-01-11", "BLS_CPI_DETAIL", 3.4),
    ("2024-01-26", "BEA_PCE", None),
    ("2024-01-31", "FOMC_RATE_DECISION", 5.33),
    ("2024-02-02", "BLS_JOBS_REPORT", 353.0),
    ("2024-02-13", "BLS_CPI_DETAIL", 3.1),
    ("2024-02-28", "BEA_GDP_SECOND", 3.2),
    ("2024-03-08", "BLS_JOBS_REPORT", 275.0),
    ("2024-03-12", "BLS_CPI_DETAIL", 3.2),
    ("2024-03-20", "FOMC_RATE_DECISION", 5.33),
    ("2024-03-28", "BEA_PCE", None),
    ("2024-04-05", "BLS_JOBS_REPORT", 303.0),
    ("2024-04-10", "BLS_CPI_DETAIL", 3.5),
    ("2024-04-25", "BEA_GDP_ADVANCE", 1.6),
    ("2024-05-03", "BLS_JOBS_REPORT", 175.0),
    ("2024-05-15", "BLS_CPI_DETAIL", 3.4),
    ("2024-06-07", "BLS_JOBS_REPORT", 272.0),
    ("2024-06-12", "FOMC_RATE_DECISION", 5.33),
    ("2024-07-05", "BLS_JOBS_REPORT", 206.0),
    ("2024-07-11", "BLS_CPI_DETAIL", 3.0),
    ("2024-07-26", "BEA_GDP_ADVANCE", 2.8),
    ("2024-09-18", "FOMC_RATE_DECISION", 5.0),
    ("2024-11-07", "FOMC_RATE_DECISION", 4.75),
    ("2024-12-18", "FOMC_RATE_DECISION", 4.5),
]

# Releases whose surprises move markets.
HIGH_IMPACT_RELEASES = ["FOMC_RATE_DECISION", "BEA_GDP_ADVANCE", "BLS_JOBS_REPORT", "BLS_CPI_DETAIL"]

# Thresholds (strict comparisons).
HIGH_IMPACT_SURPRISE_PCT = 5
ANOMALY_SURPRISE_PCT = 10
DIRECTION_UP_FACTOR = 1.001
DIRECTION_DOWN_FACTOR = 0.999
SURPRISE_DECIMALS = 4
WATERMARK_DELAY = "1 hour"
TRIGGER_INTERVAL = "30 seconds"
RETENTION_HOURS = 168
LAG_ALERT_THRESHOLD = 10000
SINK_PARTITION_COLUMNS = ["source", "processing_date"]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

EVENT_FIELDS = [
    "event_id", "source", "release_name", "indicator", "period", "value",
    "prior_value", "surprise_pct", "revision", "consensus", "release_ts", "ingested_ts",
]

# JSON payload schema of one release event; ``from_json`` makes every field nullable.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("release_name", T.StringType(), True),
    T.StructField("indicator", T.StringType(), True),
    T.StructField("period", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("prior_value", T.DoubleType(), True),
    T.StructField("surprise_pct", T.DoubleType(), True),
    T.StructField("revision", T.BooleanType(), True),
    T.StructField("consensus", T.DoubleType(), True),
    T.StructField("release_ts", T.StringType(), True),
    T.StructField("ingested_ts", T.StringType(), True),
])

# Kafka-shaped bus row (the streaming source contract).
BUS_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Columns of the serving (JDBC) row, in order.
SERVING_COLUMNS = [
    "event_id", "source", "release_name", "indicator", "period", "value", "prior_value",
    "surprise_pct", "consensus", "market_impact", "value_direction", "is_anomaly",
    "anomaly_reason", "revision", "release_ts", "processed_ts",
]

# Columns of the alert payload, in order.
ALERT_COLUMNS = [
    "event_id", "source", "release_name", "indicator", "period", "value",
    "surprise_pct", "anomaly_reason", "market_impact", "processed_ts",
]


def _literal_frame(spark: SparkSession, rows: list[tuple], names: list[str], types: list[str]) -> DataFrame:
    """A small fixed table built JVM-side (literal array of structs + inline)."""
    from pyspark.sql import functions as F

    def lit(v, t):
        return F.lit(None).cast(t) if v is None else F.lit(v).cast(t)

    structs = [F.struct(*[lit(v, t).alias(n) for v, n, t in zip(r, names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def catalog_df(spark: SparkSession) -> DataFrame:
    """The 13-row release catalog (fixed size: always safe to broadcast)."""
    return _literal_frame(spark, RELEASE_CATALOG, ["release_name", "indicator", "source", "frequency"],
                          ["string"] * 4)


def calendar_df(spark: SparkSession) -> DataFrame:
    """The 24-row 2024 release calendar."""
    return _literal_frame(spark, RELEASE_CALENDAR_2024, ["release_date", "release_name", "expected_value"],
                          ["string", "string", "double"])
