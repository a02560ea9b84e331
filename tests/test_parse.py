"""Parser edge rows: malformed JSON, missing fields, type mismatches, dead-letter reasons."""

from pyspark.sql import functions as F

from releaseflow.functions.enrich import enrich
from releaseflow.functions.parse import dead_letters, parse_bus, type_mismatches, valid_events
from releaseflow.schema import BUS_SCHEMA

GOOD = ('{"event_id":"1","source":"BLS","release_name":"BLS_JOBS_REPORT","indicator":"nfp",'
        '"period":"2024-01","value":353.0,"prior_value":216.0,"consensus":180.0,"revision":false}')
PAYLOADS = [
    GOOD,
    "not json",
    '{"event_id":"6","source":"BLS"',
    "[]",
    "{}",
    None,
    '{"event_id":"2","source":"BLS","indicator":"x","value":"353.0","consensus":180.0}',
    '{"event_id":"7","source":"BLS","indicator":"x","value":{"a":1},"consensus":180.0}',
    '{"event_id":"3","source":"BLS","indicator":"x","value":NaN,"consensus":180.0}',
    '{"event_id":"4","source":"BLS","indicator":"x","value":1.0,"consensus":0,"extra":1}',
    '{"event_id":5,"source":"BLS","indicator":"x","value":1.0,"revision":"true"}',
    '{"event_id":"","source":"","indicator":""}',
    '{"event_id":"8","source":"BLS","value":1.0}',
]


def _bus(spark):
    rows = [(None, None if p is None else bytearray(p.encode()), "t", 0, i, None)
            for i, p in enumerate(PAYLOADS)]
    return spark.createDataFrame(rows, BUS_SCHEMA).withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_valid_and_dead_letters_partition_the_input(spark):
    parsed = parse_bus(_bus(spark))
    valid = {r.offset for r in valid_events(parsed).collect()}
    dlq = {r.offset: r for r in dead_letters(parsed).collect()}
    assert valid.isdisjoint(dlq) and valid | set(dlq) == set(range(len(PAYLOADS)))
    assert valid == {0, 6, 7, 8, 9, 10, 11}
    assert dlq[1].dlq_reason == "malformed_json"
    assert dlq[2].dlq_reason == "malformed_json"
    assert dlq[3].dlq_reason in ("malformed_json", "missing_field")
    assert dlq[4].dlq_reason == "missing_field"
    assert dlq[5].dlq_reason == "null_payload"
    assert dlq[12].dlq_reason == "missing_field" and dlq[12].missing_fields == "indicator"


def test_type_mismatch_rows_stay_in_main_path(spark):
    parsed = parse_bus(_bus(spark))
    mism = {r.offset for r in type_mismatches(parsed).collect()}
    assert {6, 7, 10} <= mism
    out = {r.event_id: r for r in enrich(valid_events(parsed)).collect()}
    assert out["2"].value is None and out["2"].anomaly_reason == "Missing value"
    assert out["7"].value is None and out["7"].is_anomaly is True
    assert out["5"].revision is None
    assert out["4"].surprise_pct is None and out["4"].is_anomaly is False
    assert out["3"].anomaly_reason == "Large surprise: NaN%"
    assert out[""].anomaly_reason == "Missing value"


def test_dead_letter_bus_messages(spark):
    import json

    from releaseflow.streaming.sinks import JdbcServingTarget, dead_letter_messages
    msgs = {r.key: json.loads(r.value) for r in dead_letter_messages(dead_letters(parse_bus(_bus(spark)))).collect()}
    assert set(msgs) == {"malformed_json", "missing_field", "null_payload"}
    assert msgs["null_payload"]["dlq_reason"] == "null_payload" and "payload" not in msgs["null_payload"]
    t = JdbcServingTarget("jdbc:postgresql://db:5432/econ")
    assert t.properties["stringtype"] == "unspecified"
