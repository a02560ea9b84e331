"""Quarantine before serving, progress log, window totals, as-of joins, polled values, ids."""

import json
import os
import random
import uuid as uuids
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from releaseflow.functions import parse as P
from releaseflow.functions.enrich import enrich, value_direction_expr
from releaseflow.functions.parse import parse_bus, valid_events
from releaseflow.operators import history as H
from releaseflow.operators.integrity import COLUMN_WIDTHS, UUID_PATTERN, constraint_check, quarantine_split
from releaseflow.operators.monitor import (
    ProgressLog,
    WindowTotals,
    batch_progress,
    windowed_counts,
    windowed_counts_from_partials,
)
from releaseflow.operators.sequence import asof_last, bucketed_row_number
from releaseflow.plans.common import releases
from releaseflow.sources.events import bus_rows
from releaseflow.sources.table import VersionedTable
from releaseflow.streaming.job import FanOut, StreamConfig, file_bus, routed_stream, start
from releaseflow.streaming.sinks import DeadLetterSink, JdbcServingTarget, ParquetServingTarget

from conftest import SF_SMALL


# -- quarantine ------------------------------------------------------------------------------------


def test_serving_rows_always_meet_the_constraints(spark, workdir):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    text = F.col("value").cast("string")
    wide = F.regexp_replace(text, '"period":"', '"period":"' + "x" * 30)
    bad = bus.withColumn("value", F.when(F.col("offset") % 10 == 3, wide).otherwise(text).cast("binary"))
    target = ParquetServingTarget(f"{workdir}/serving")
    target.id_pattern = "[0-8]$"  # stands for the UUID form: ids here are numbers
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"), serving=target,
                 dead_letters=DeadLetterSink(f"{workdir}/dlq"))
    rows = routed_stream(bad).dropDuplicates(["_dedup_key"]).persist()
    fan(rows, 0)
    table, serving = fan.table.scan(), spark.read.parquet(f"{workdir}/serving")
    report = constraint_check(serving).first()
    assert report["n_too_wide"] == 0 and report["n_null_period"] == 0
    assert serving.filter("event_id NOT RLIKE '[0-8]$'").count() == 0
    letters = spark.read.parquet(f"{workdir}/dlq").filter("dlq_reason = 'constraint'")
    assert letters.count() == fan.refused[0] > 0
    assert serving.count() + letters.count() == table.count()  # the table itself keeps every valid row
    assert {v for r in letters.collect() for v in r["missing_fields"].split(",")} == {"wide:period", "form:event_id"}
    assert letters.filter("payload IS NULL").count() == 0


def test_quarantine_reasons(spark):
    ok = str(uuids.uuid4())
    rows = [(ok, "s", "r", "i", "p"), (None, "s", "r", "i", "p"), ("x", "s" * 21, "r", None, "p"), (ok, "s" * 20, "r", "i", "p")]
    df = spark.createDataFrame(rows, "event_id string, source string, release_name string, indicator string, period string")
    good, refused = quarantine_split(df, id_pattern=UUID_PATTERN)
    assert good.count() == 2 and good.columns == df.columns
    assert sorted(map(sorted, (r["violations"] for r in refused.collect()))) == [
        ["form:event_id", "null:indicator", "wide:source"], ["null:event_id"]]
    assert JdbcServingTarget("jdbc:postgresql://x/y").id_pattern == UUID_PATTERN
    assert ParquetServingTarget("p").id_pattern is None
    assert set(COLUMN_WIDTHS) < set(df.columns)


# -- progress and windows --------------------------------------------------------------------------


def test_the_job_logs_each_batch(spark, workdir):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    for i in range(2):
        bus.filter(F.col("offset") % 2 == i).coalesce(1).write.parquet(f"{workdir}/landing/f{i}")
    cfg = StreamConfig(root=f"{workdir}/out", checkpoint_root=f"{workdir}/ckpt", trigger={"availableNow": True},
                       history_window_us=None)
    qs = start(spark, file_bus(spark, f"{workdir}/landing/*", max_files_per_trigger=1), cfg)
    assert qs["main"].awaitTermination(600)
    import time
    for _ in range(100):  # listeners are told a moment later
        qs["listener"].flush()
        if os.path.isdir(f"{workdir}/out/progress") and batch_progress(spark, f"{workdir}/out/progress").count() >= 2:
            break
        time.sleep(0.2)
    spark.streams.removeListener(qs["listener"])
    got = batch_progress(spark, f"{workdir}/out/progress").orderBy("batch_id").collect()
    assert [r["batch_id"] for r in got][:2] == [0, 1] and {r["query"] for r in got} == {"releases_main"}
    assert sum(r["input_rows"] for r in got) == bus.count()
    assert all(r["lag"] == 0 and r["rows_dropped_by_watermark"] == 0 and not r["alert"] for r in got)


def test_progress_of_a_bus_source(spark, workdir):
    def offsets(n):
        return json.dumps({"releases": {"0": n, "1": 5}})

    progress = {"id": "q", "name": "main", "batchId": 4, "timestamp": "t", "numInputRows": 7, "processedRowsPerSecond": 3.5,
                "sources": [{"startOffset": offsets(10), "endOffset": offsets(20), "latestOffset": offsets(2000)}],
                "stateOperators": [{"operatorName": "dedupe", "numRowsDroppedByWatermark": 2, "numRowsTotal": 9}]}
    log = ProgressLog(spark, f"{workdir}/p", ("main",), threshold=1000)
    log.record(progress)
    log.record({**progress, "name": "other"})
    log.ids = {"another run"}
    log.record({**progress, "batchId": 5})
    log.flush()
    log.flush()  # nothing new
    (r,) = batch_progress(spark, f"{workdir}/p").collect()
    assert (r["batch_id"], r["lag"], r["alert"], r["bus_partitions"]) == (4, 1980, True, 2)
    assert (r["rows_dropped_by_watermark"], r["offsets_skipped"], r["input_rows"]) == (2, 3, 7)


def test_window_totals_follow_the_days_not_the_batches(spark, workdir):
    valid = enrich(valid_events(parse_bus(bus_rows(releases(spark, SF_SMALL)).drop("seq"))).dropDuplicates(["event_id"]))
    valid = valid.filter("kafka_ts < '2024-01-04'").persist()
    totals = WindowTotals(spark, f"{workdir}/w")
    parts = 8
    for n in range(parts):
        totals.add(valid.filter(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == n), n)
    totals = WindowTotals(spark, f"{workdir}/w")
    totals.add(valid.filter(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == parts - 1), parts - 1)  # a replay
    cols = ["window_start", "window_end", "source", "n_events", "n_anomalies", "n_high_impact"]
    got = windowed_counts_from_partials(spark, f"{workdir}/w").select(*cols)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, windowed_counts(valid).select(*cols).collect()))
    days = [d for d in os.listdir(f"{workdir}/w") if d.startswith("bucket=")]
    assert len(days) == 3
    assert all(len([v for v in os.listdir(f"{workdir}/w/{d}") if v.startswith("version=")]) <= 2 for d in days)


# -- as-of joins -----------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket_seconds", [60, 3600, 10 ** 7])
def test_asof_last_equals_brute_force(spark, bucket_seconds):
    rng = random.Random(bucket_seconds)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(i, rng.choice(keys), rng.randrange(20_000)) for i in range(400)]
    right = [(rng.choice(keys), rng.randrange(20_000), j, rng.choice([None, float(j)])) for j in range(300)]
    ldf = spark.createDataFrame(left, "lid long, k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    rdf = spark.createDataFrame(right, "k string, s long, seq long, v double").withColumn("ts", F.timestamp_seconds("s"))
    got = asof_last(ldf, rdf, ["k"], "ts", ["seq"], ["v", "seq"], bucket_seconds)
    assert got.count() == len(left)
    got = {r["lid"]: (r["v"], r["seq"]) for r in got.collect()}
    for lid, k, s in left:
        known = [r for r in right if k is not None and r[0] == k and r[1] <= s]
        best = max(known, key=lambda r: (r[1], r[2]), default=None)
        assert got[lid] == ((best[3], best[2]) if best else (None, None))


def test_row_numbers_across_buckets(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.choice("xy"), rng.randrange(9000)) for i in range(300)],
                               "i long, k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r["i"]: r["n"] for r in bucketed_row_number(df, ["k"], "ts", ["i"], "n", 600).collect()}
    for k in "xy":
        rows = sorted((r["s"], r["i"]) for r in df.collect() if r["k"] == k)
        assert [got[i] for _, i in rows] == list(range(1, len(rows) + 1))


def test_prior_as_known_sees_no_later_revision(spark):
    rows = [("e1", "R", "2024-01", 1.0, 10), ("e2", "R", "2024-02", 5.0, 20), ("e3", "R", "2024-01", 2.0, 25),
            ("e4", "R", "2024-02", 6.0, 30), ("e5", "R", "2024-01", None, 40), ("e6", "R", "2024-03", 9.0, 5)]
    df = spark.createDataFrame(rows, "event_id string, release_name string, period string, value double, s long").select(
        "*", F.timestamp_seconds("s").alias("kafka_ts"), F.col("s").alias("seq"))
    got = {r["event_id"]: (r["prior_known"], r["prior_vintage"], r["prior_event_id"]) for r in H.prior_as_known(df).collect()}
    assert got == {"e1": (None, None, None), "e2": (1.0, 1, "e1"), "e3": (None, None, None), "e4": (2.0, 2, "e3"),
                   "e5": (None, None, None), "e6": (None, None, None)}


@pytest.mark.parametrize("tolerance", [0, 1, 3, 10])
def test_schedule_matching_equals_brute_force(spark, tolerance):
    rng = random.Random(tolerance)
    first = date(2024, 1, 1)
    days = sorted({(rng.choice("RS"), first + timedelta(rng.randrange(-40, 120))) for _ in range(80)})
    planned = sorted({(rng.choice("RS"), first + timedelta(rng.randrange(100))) for _ in range(20)})
    ddf = spark.createDataFrame([(r, d, 1) for r, d in days] + [(None, first, 1), ("R", None, 1)],
                                "release_name string, release_date date, n_events int")
    cal = spark.createDataFrame([(r, d.isoformat(), float(i)) for i, (r, d) in enumerate(planned)] + [(None, "2024-01-01", 0.0)],
                                "release_name string, release_date string, expected_value double")
    got = H.match_schedule(ddf, cal, tolerance).collect()
    assert len(got) == len(days) + 2
    for r in got:
        near = [] if r["release_name"] is None or r["release_date"] is None else [
            (abs((r["release_date"] - d).days), d) for p, d in planned
            if p == r["release_name"] and abs((r["release_date"] - d).days) <= tolerance]
        assert r["matched_date"] == (min(near)[1] if near else None)
        assert r["days_off"] == ((r["release_date"] - min(near)[1]).days if near else None)


# -- values and ids --------------------------------------------------------------------------------


def test_observed_values(spark):
    texts = ["1.5", " 2 ", ".", " . ", None, "n/a", "", "-3e2", "1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "value_text string")
    got = [(r["value"], r["is_missing"], r["is_unreadable"]) for r in P.parse_observations(df).collect()]
    assert got == [(1.5, False, False), (2.0, False, False), (None, True, False), (None, True, False), (None, True, False),
                   (None, False, True), (None, False, True), (-300.0, False, False), (None, False, True)]


def test_generated_ids_are_stable_and_of_uuid_shape(spark):
    df = spark.createDataFrame([("a", "b", None), ("a", None, "b"), ("ab", "", None), ("a", "b", None)],
                               "x string, y string, z string")
    ids = [r[0] for r in df.select(P.generated_event_id("x", "y", "z")).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3] and all(str(uuids.UUID(i)) == i for i in ids)


def test_direction_bands(spark):
    rows = [(-9.0, -10.0), (-11.0, -10.0), (10.0, 10.0), (10.02, 10.0), (9.98, 10.0), (None, 1.0), (1.0, None), (0.5, 0.0)]
    df = spark.createDataFrame(rows, "v double, p double")
    v, p = F.col("v"), F.col("p")
    signed = [r[0] for r in df.select(value_direction_expr(v, p)).collect()]
    size = [r[0] for r in df.select(value_direction_expr(v, p, "abs")).collect()]
    assert size == ["UP", "DOWN", "FLAT", "UP", "DOWN", "FLAT", "UNKNOWN", "UP"]
    assert signed[2:] == size[2:]
    with pytest.raises(ValueError):
        value_direction_expr(v, p, "other")


def test_rows_without_release_or_period_are_reported(spark):
    bus = bus_rows(releases(spark, SF_SMALL).limit(40)).drop("seq")
    text = F.regexp_replace(F.col("value").cast("string"), '"period":"[^"]*",', "")
    parsed = parse_bus(bus.withColumn("value", text.cast("binary")))
    letters = P.warned(parsed).collect()
    assert {(r["dlq_reason"], r["missing_fields"]) for r in letters} == {("incomplete", "period")}
    assert len(letters) == valid_events(parsed).count() > 0
