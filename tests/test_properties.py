"""Property tests: the enrichment rules against a plain-Python statement of them,
and the lag helper on synthetic progress reports."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from releaseflow.functions.enrich import enrich
from releaseflow.operators.monitor import progress_lag
from releaseflow.schema import HIGH_IMPACT_RELEASES, RELEASE_CATALOG

NAMES = [r[0] for r in RELEASE_CATALOG] + ["UNKNOWN"]
cents = st.integers(min_value=-50_000, max_value=50_000).map(lambda c: c / 100.0)
maybe = st.one_of(st.none(), cents, st.sampled_from([0.0, -0.0]))
row = st.tuples(st.one_of(st.none(), cents), maybe, maybe, st.sampled_from(NAMES),
                st.one_of(st.none(), st.booleans()))


def expected(value, prior, consensus, name, revision):
    if consensus is None or consensus == 0:
        s = None
    else:
        raw = (value - consensus) / abs(consensus) * 100 if value is not None else None
        s = None if raw is None else float(Decimal(repr(raw)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
    high = name in HIGH_IMPACT_RELEASES
    if high and s is not None and abs(s) > 5:
        impact = "HIGH"
    elif high:
        impact = "MEDIUM"
    elif revision is True:
        impact = "LOW"
    else:
        impact = "MEDIUM"
    if prior is None:
        direction = "UNKNOWN"
    elif value is not None and value > prior * 1.001:
        direction = "UP"
    elif value is not None and value < prior * 0.999:
        direction = "DOWN"
    else:
        direction = "FLAT"
    anomaly = (s is not None and abs(s) > 10) or value is None
    return s, impact, direction, anomaly


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=60))
def test_enrichment_matches_rules(spark, rows):
    df = spark.createDataFrame(
        rows, "value double, prior_value double, consensus double, release_name string, revision boolean")
    out = enrich(df, clock=F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()
    for r, o in zip(rows, out):
        s, impact, direction, anomaly = expected(*r)
        assert (o.surprise_pct, o.market_impact, o.value_direction, o.is_anomaly) == \
               (s, impact, direction, anomaly), r


def test_progress_lag(spark):
    progress = {"sources": [{
        "description": "KafkaV2[Subscribe[econ.releases.raw]]",
        "endOffset": '{"econ.releases.raw":{"0":100,"1":250,"2":7}}',
        "latestOffset": '{"econ.releases.raw":{"0":130,"1":250,"2":9}}'}]}
    rows = {r.partition: r for r in progress_lag(spark, progress).collect()}
    assert {p: r.lag for p, r in rows.items()} == {0: 30, 1: 0, 2: 2}
    assert progress_lag(spark, None).count() == 0
    assert progress_lag(spark, {"sources": [{"endOffset": None, "latestOffset": None}]}).count() == 0


events = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
              st.integers(min_value=0, max_value=50).map(lambda m: m * 600_000_000),  # 10-min steps, ties allowed
              st.one_of(st.none(), st.integers(min_value=-500, max_value=500).map(lambda c: c / 10.0))),
    min_size=1, max_size=80)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from([600, 3600, 7200]), st.sampled_from([1, 2, 3]))
def test_bucketed_operators_match_windows(spark, rows, bucket_s, window_buckets):
    from pyspark.sql import Window

    from releaseflow.operators.rolling import rolling_range_stats
    from releaseflow.operators.sequence import bucketed_lag
    df = (spark.createDataFrame([(i, k, t, v) for i, (k, t, v) in enumerate(rows)],
                                "rid long, k string, t long, v double")
          .withColumn("ts", F.timestamp_micros("t")))
    got = {r.rid: r.p for r in bucketed_lag(df, ["k"], "ts", ["rid"], ["v"], ["p"], bucket_s).collect()}
    exp = {r.rid: r.p for r in df.withColumn(
        "p", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "rid"))).collect()}
    assert got == exp
    B = bucket_s * 1_000_000
    W = window_buckets * B
    st_ = {r.rid: r for r in rolling_range_stats(df, ["k"], "ts", "v", ["rid"], W, B).collect()}
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-W, -1)
    for r in df.select("rid", F.count("v").over(w).alias("n"), F.min("v").over(w).alias("mn"),
                       F.max("v").over(w).alias("mx")).collect():
        g = st_[r.rid]
        assert (g.hist_n, g.hist_min, g.hist_max) == (r.n, r.mn, r.mx)
