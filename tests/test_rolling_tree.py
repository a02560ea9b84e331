"""Summary tree, stable spreads and the repair of given context by late rows."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from releaseflow.functions.enrich import enrich
from releaseflow.functions.parse import parse_bus, valid_events
from releaseflow.operators.history import hist_context, rolling_zscore, rolling_zscore_obs
from releaseflow.operators.rolling import DAY_US, HOUR_US, covering_nodes, rolling_range_stats, tree_levels
from releaseflow.plans.common import releases
from releaseflow.sources.events import bus_rows
from releaseflow.sources.table import VersionedTable
from releaseflow.streaming.history import StreamingHistory, current_context
from releaseflow.streaming.job import FanOut

from conftest import SF_SMALL


def test_covering_nodes_hold_each_bucket_once(spark):
    spans = [(a, a + n) for a in (-70, -1, 0, 3, 5, 64, 255, 1000) for n in (0, 1, 2, 3, 7, 16, 63, 64, 200)]
    df = spark.createDataFrame(spans, "a long, b long")
    levels = tree_levels(200)
    for r in df.select("a", "b", covering_nodes(F.col("a"), F.col("b"), levels).alias("nodes")).collect():
        held = [k for n in r["nodes"] for k in range(n["node"] << (2 * n["level"]), (n["node"] + 1) << (2 * n["level"]))]
        assert sorted(held) == list(range(r["a"], r["b"]))
        assert len(r["nodes"]) <= 6 * levels
    assert len(max((r["nodes"] for r in df.select(covering_nodes(
        F.lit(12345).cast("long"), F.lit(12345 + 8759).cast("long"), tree_levels(8759)).alias("nodes")).limit(1)
        .collect()), key=len)) <= 42


def _series(spark, base, n=300, key="X"):
    rng = random.Random(11)
    rows = [(str(i), key, base + rng.choice([-0.2, -0.1, 0.0, 0.1, 0.2]), i * 1700) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, indicator string, value double, s long").withColumn(
        "kafka_ts", F.timestamp_seconds(F.col("s") + 1_700_000_000))


@pytest.mark.parametrize("base", [0.0, 1e6, 1e9, -1e9])
def test_narrow_series_keep_their_spread(spark, base):
    df = _series(spark, base)
    rows = {r["event_id"]: r for r in df.collect()}
    got = rolling_zscore(df, window_us=2 * DAY_US).collect()
    by_obs = {r["event_id"]: r for r in rolling_zscore_obs(df, 12).collect()}
    for r in got:
        k, t = int(r["event_id"]), rows[r["event_id"]]["s"]
        frame = [rows[str(j)]["value"] for j in range(k) if t - rows[str(j)]["s"] <= 2 * 86400]
        assert r["hist_n"] == len(frame)
        last = [rows[str(j)]["value"] for j in range(max(0, k - 12), k)]
        for sd, values in ((r["hist_std"], frame), (by_obs[r["event_id"]]["hist_std"], last)):
            if len(values) > 1:
                assert sd == pytest.approx(statistics.stdev(values), abs=2e-6)
            else:
                assert sd is None


def test_equal_values_have_no_spread(spark):
    df = _series(spark, 0.0).withColumn("value", F.lit(0.1))
    for out in (rolling_zscore(df, window_us=DAY_US), rolling_zscore_obs(df, 12)):
        assert {r["hist_std"] for r in out.filter("hist_n > 1").collect()} == {0.0}
        assert out.filter("zscore IS NOT NULL").count() == 0


def test_wide_windows_go_through_the_tree(spark):
    """Hour buckets, windows of days: every statistic equals the plain window, and no window is keyed by the key alone."""
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(40 * 24 * 3600),
             None if rng.random() < 0.1 else round(rng.uniform(-5, 5), 3)) for i in range(2500)]
    df = spark.createDataFrame(rows, "rid long, k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    w_us = 17 * DAY_US
    got = rolling_range_stats(df, ["k"], "ts", "v", ["rid"], w_us, HOUR_US)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_rr_b" in line for line in windows)
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-w_us, -1)
    exp = df.select("rid", F.count("v").over(w).alias("n"), F.sum(F.col("v").cast("decimal(38,9)")).over(w).alias("d"),
                    F.var_pop("v").over(w).alias("var"), F.min("v").over(w).alias("lo"), F.max("v").over(w).alias("hi"))
    exp = {r["rid"]: r for r in exp.collect()}
    for r in got.collect():
        e = exp[r["rid"]]
        assert (r["hist_n"], r["hist_dsum"], r["hist_min"], r["hist_max"]) == (e["n"], e["d"], e["lo"], e["hi"])
        assert r["hist_m2"] == pytest.approx(e["var"] * e["n"], rel=1e-9, abs=1e-9) if e["n"] else r["hist_m2"] is None


def _parts(spark, seed, n):
    """Valid events dealt to ``n`` batches without regard to time."""
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    valid = enrich(valid_events(parse_bus(bus)).dropDuplicates(["event_id"]), clock=F.col("kafka_ts"))
    part = F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(n))
    return valid, [valid.filter(part == k) for k in range(n)]


def _assert_equal_to_batch(spark, path, valid, window_us):
    got = {r["event_id"]: r for r in current_context(spark, path).collect()}
    ctx = {r["event_id"]: r for r in hist_context(valid, window_us=window_us).collect()}
    z = {r["event_id"]: r for r in rolling_zscore(valid, window_us=window_us).collect()}
    assert set(got) == set(ctx)
    for k, r in got.items():
        assert (r["hist_n"], r["hist_min"], r["hist_max"], r["hist_mean"]) == (
            ctx[k]["hist_n"], ctx[k]["hist_min"], ctx[k]["hist_max"], ctx[k]["hist_mean"]), k
        assert r["is_zscore_anomaly"] == z[k]["is_zscore_anomaly"]
        for c in ("hist_std", "zscore"):
            a, b = r[c], z[k][c]
            assert (a is None and b is None) or math.isclose(a, b, abs_tol=2e-4), (k, c, a, b)


def test_any_order_of_arrival_equals_the_batch_window(spark, workdir):
    window = 7 * DAY_US
    valid, parts = _parts(spark, 3, 4)
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"), history_path=f"{workdir}/context",
                 history=StreamingHistory(spark, f"{workdir}/state", window))
    for batch_id, rows in enumerate(parts):
        fan(rows, batch_id)
    _assert_equal_to_batch(spark, f"{workdir}/context", valid, window)
    # a replay of the last batch, by a process that has just started, changes nothing
    again = FanOut(table=VersionedTable(spark, f"{workdir}/t"), history_path=f"{workdir}/context",
                   history=StreamingHistory(spark, f"{workdir}/state", window))
    again(parts[-1], len(parts) - 1)
    _assert_equal_to_batch(spark, f"{workdir}/context", valid, window)


def test_one_late_row_reads_its_own_days_only(spark, workdir):
    day = 86400
    hist = StreamingHistory(spark, workdir, 20 * DAY_US)
    schema = "event_id string, indicator string, value double, s long"

    def batch(*rows):
        return spark.createDataFrame(list(rows), schema).withColumn("kafka_ts", F.timestamp_seconds("s"))

    for k in range(12):
        rows = batch(*((f"{k}-{key}", key, float(k), k * day + 60) for key in "AB"))
        hist.emit(hist.process(rows, k), k)
        hist.commit(rows, k)
    read = []
    plain = hist._rows
    hist._rows = lambda buckets, before: (read.append(list(buckets)), plain(buckets, before))[1]
    late = batch(("late", "A", 100.0, 2 * day + 30), ("now", "A", 11.0, 11 * day + 90))
    out = {r["event_id"]: r for r in hist.process(late, 12).collect()}
    assert set(map(tuple, read)) <= {(2, 11), (), (11,)}  # not the days between them
    assert out["late"]["hist_n"] == 2 and out["now"]["hist_n"] == 13
    assert set(out) == {"late", "now", *(f"{k}-A" for k in range(2, 12))}  # B's rows keep theirs
    assert out["5-A"]["hist_n"] == 6 and out["5-A"]["hist_max"] == 100.0
    hist.emit(hist.process(late, 12), 12)
    hist.commit(late, 12)
    nxt = batch(("next", "A", 1.0, 12 * day))
    got = hist.process(nxt, 13).first()
    assert got["hist_n"] == 14 and got["hist_mean"] == pytest.approx((sum(range(12)) + 111.0) / 14)
