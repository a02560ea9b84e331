"""Bucketed lag and rolling statistics against brute-force windows, with a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from releaseflow.operators.rolling import rolling_range_stats, rolling_rows_stats
from releaseflow.operators.sequence import bucketed_lag

HOUR_US = 3_600_000_000


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    t = 1_700_000_000_000_000
    for i in range(n):
        t += rnd.choice([0, 1, 5_000_000, 60_000_000, HOUR_US, 5 * HOUR_US])
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c"])
        v = None if rnd.random() < 0.05 else round(rnd.uniform(-50, 150), 2)
        rows.append((i, key, t, v))
    return (spark.createDataFrame(rows, "rid long, k string, t long, v double")
            .withColumn("ts", F.timestamp_micros("t")))


@pytest.mark.parametrize("bucket_seconds", [60, 3600, 86400])
def test_bucketed_lag_matches_window(spark, bucket_seconds):
    df = _data(spark)
    got = bucketed_lag(df, ["k"], "ts", ["rid"], ["v"], ["prev_v"], bucket_seconds=bucket_seconds)
    w = Window.partitionBy("k").orderBy("ts", "rid")
    exp = df.withColumn("prev_v", F.lag("v").over(w))
    a = {r.rid: r.prev_v for r in got.select("rid", "prev_v").collect()}
    b = {r.rid: r.prev_v for r in exp.select("rid", "prev_v").collect()}
    assert a == b


@pytest.mark.parametrize("window_h,bucket_h", [(6, 1), (6, 6), (24, 3)])
def test_rolling_range_matches_window(spark, window_h, bucket_h):
    df = _data(spark)
    W, B = window_h * HOUR_US, bucket_h * HOUR_US
    got = rolling_range_stats(df, ["k"], "ts", "v", ["rid"], W, B, prefix="h_")
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-W, -1)
    exp = df.select("rid", F.count("v").over(w).alias("n"), F.sum("v").over(w).alias("s"),
                    F.min("v").over(w).alias("mn"), F.max("v").over(w).alias("mx"))
    a = {r.rid: r for r in got.collect()}
    for r in exp.collect():
        g = a[r.rid]
        assert g.h_n == r.n
        assert g.h_min == r.mn and g.h_max == r.mx
        assert (g.h_sum is None and r.s is None) or g.h_sum == pytest.approx(r.s, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("n_rows,bucket_h", [(12, 1), (3, 24), (12, 1000)])
def test_rolling_rows_matches_window(spark, n_rows, bucket_h):
    df = _data(spark)
    got = rolling_rows_stats(df, ["k"], "ts", ["rid"], "v", n_rows, bucket_h * HOUR_US, prefix="o_")
    w = Window.partitionBy("k").orderBy("t", "rid").rowsBetween(-n_rows, -1)
    exp = df.select("rid", F.count("v").over(w).alias("n"), F.sum("v").over(w).alias("s"))
    a = {r.rid: r for r in got.collect()}
    for r in exp.collect():
        g = a[r.rid]
        assert g.o_n == r.n, r.rid
        assert (g.o_sum is None and r.s is None) or g.o_sum == pytest.approx(r.s, rel=1e-9, abs=1e-9)


def test_event_windows_are_partitioned_by_key_and_bucket(spark):
    """Windows over event rows are keyed by (key, bucket), not by the key alone."""
    df = _data(spark)
    got = rolling_range_stats(df, ["k"], "ts", "v", ["rid"], 6 * HOUR_US, HOUR_US)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "_rr_b" in plan
