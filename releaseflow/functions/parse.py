"""Parse, validate and route bus records.

The parse keeps the raw payload, the parsed struct and the corrupt-record
marker in one projection, so the valid/dead-letter split is decided on the
same row that is parsed (JSON pruning cannot make the two sides disagree).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releaseflow.schema import EVENT_FIELDS, EVENT_SCHEMA

CORRUPT = "_corrupt_record"
PARSE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
REQUIRED = ["event_id", "source", "indicator"]

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_bus(bus: DataFrame) -> DataFrame:
    """Bus rows -> kafka_ts, partition, offset, payload, event fields, _corrupt_record.

    The parsed struct is expanded with a one-element ``inline``: its fields are
    then generator outputs, so the validity filter cannot be pushed below the
    parse and re-evaluate ``from_json`` (Catalyst would otherwise inline the
    parse into the pushed-down filter and decode every payload twice). A null
    payload still yields one all-null row.
    """
    payload = F.col("value").cast("string")
    return bus.select(F.col("timestamp").alias("kafka_ts"), "partition", "offset",
                      payload.alias("payload"),
                      F.inline(F.array(F.from_json(payload, PARSE_SCHEMA, JSON_OPTIONS))))


def is_valid() -> Column:
    cond = None
    for c in REQUIRED:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return cond


def valid_events(parsed: DataFrame) -> DataFrame:
    """Rows that pass the validity filter, payload columns dropped."""
    return parsed.filter(is_valid()).drop("payload", CORRUPT)


def _missing_list() -> Column:
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])


def dlq_reason() -> Column:
    """null_payload > malformed_json > missing_field (first match wins)."""
    return (F.when(F.col("payload").isNull(), F.lit("null_payload"))
            .when(F.col(CORRUPT).isNotNull() & F.col("event_id").isNull(), F.lit("malformed_json"))
            .when(~is_valid(), F.lit("missing_field")))


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Complement of the validity filter with a reason (the DLQ side output)."""
    return (parsed.filter(~is_valid() | F.col("payload").isNull())
            .select("kafka_ts", "partition", "offset", "event_id", "payload",
                    dlq_reason().alias("dlq_reason"),
                    F.when(dlq_reason() == "missing_field", _missing_list())
                     .alias("missing_fields")))


def warned(parsed: DataFrame) -> DataFrame:
    """Valid rows without a release name or period, kept in the main path and reported as ``incomplete``."""
    lacking = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("release_name", "period")])
    return (parsed.filter(is_valid() & (F.col("release_name").isNull() | F.col("period").isNull()))
            .select("kafka_ts", "partition", "offset", "event_id", "payload",
                    F.lit("incomplete").alias("dlq_reason"), lacking.alias("missing_fields")))


def type_mismatches(parsed: DataFrame) -> DataFrame:
    """Valid rows whose payload did not fully match the schema (kept in the main path,
    reported on the DLQ as ``type_mismatch``)."""
    return (parsed.filter(is_valid() & F.col(CORRUPT).isNotNull())
            .select("kafka_ts", "partition", "offset", "event_id", "payload",
                    F.lit("type_mismatch").alias("dlq_reason"),
                    F.lit(None).cast("string").alias("missing_fields")))


#: Fixed value: how polled series write a missing observation.
MISSING_OBSERVATION = "."


def observed_value(text: Column) -> Column:
    """A polled observation's text as a number; the sentinel and unreadable text are null (fn11)."""
    return F.nullif(F.trim(text), F.lit(MISSING_OBSERVATION)).try_cast("double")


def parse_observations(polled: DataFrame, text_col: str = "value_text") -> DataFrame:
    """``value`` from the text of polled rows, ``is_missing`` (the sentinel or no text) and ``is_unreadable``."""
    text = F.trim(F.col(text_col))
    missing = text.isNull() | (text == MISSING_OBSERVATION)
    value = observed_value(F.col(text_col))
    return polled.select("*", value.alias("value"), missing.alias("is_missing"),
                         (~missing & value.isNull()).alias("is_unreadable")).drop(text_col)


def generated_event_id(*parts: str) -> Column:
    """An id of UUID shape that follows from what the event is (fn13): polling a release again gives the same.

    ``parts`` are columns; nulls count as a part of their own."""
    key = F.to_json(F.array(*(F.col(p).cast("string") for p in parts)))
    digits = F.sha2(key, 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digits, a, n) for a, n in cuts))


def event_to_json(df: DataFrame, ignore_null_fields: bool = True) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS]),
                     {"ignoreNullFields": str(ignore_null_fields).lower()})


def event_from_json(col: Column) -> Column:
    return F.from_json(col, EVENT_SCHEMA)
