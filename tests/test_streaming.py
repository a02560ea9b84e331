"""Streaming job on landed bus files: stream == batch, restart and replay safety,
dead letters, watermark drops."""

from collections import Counter

from pyspark.sql import functions as F

from releaseflow.functions.enrich import enrich
from releaseflow.functions.parse import parse_bus, valid_events
from releaseflow.plans.common import releases
from releaseflow.sources.events import bus_rows
from releaseflow.sources.table import VersionedTable
from releaseflow.streaming.job import FanOut, StreamConfig, file_bus, start
from releaseflow.streaming.sinks import ParquetServingTarget

from conftest import SF_SMALL

COLS = ["event_id", "source", "release_name", "indicator", "period", "value", "prior_value", "consensus",
        "revision", "surprise_pct", "market_impact", "value_direction", "is_anomaly", "anomaly_reason"]


def _land(spark, workdir):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    pos = (F.col("offset") % F.lit(1 << 40)) * 3 + F.col("partition")
    for i in range(4):
        (bus.filter((pos >= i * 250) & (pos < (i + 1) * 250)).coalesce(1)
            .write.parquet(f"{workdir}/landing/f{i}"))
    return bus


def _run(spark, workdir):
    src = file_bus(spark, f"{workdir}/landing/*", max_files_per_trigger=1)
    cfg = StreamConfig(root=f"{workdir}/out", checkpoint_root=f"{workdir}/ckpt",
                       trigger={"availableNow": True},
                       serving=ParquetServingTarget(f"{workdir}/out/serving"))
    qs = start(spark, src, cfg)
    for q in qs["queries"]:
        assert q.awaitTermination(600)
        assert q.exception() is None
    return qs


def test_stream_end_to_end(spark, workdir):
    bus = _land(spark, workdir)
    qs = _run(spark, workdir)
    assert len(qs["fanout"].written) == 4

    table = VersionedTable(spark, f"{workdir}/out/releases_enriched").scan()
    batch = enrich(valid_events(parse_bus(bus)).dropDuplicates(["event_id"]))
    # (a) the stream produced exactly what the batch path produces (small: compare as multisets)
    assert Counter(map(tuple, table.select(*COLS).collect())) == \
        Counter(map(tuple, batch.select(*COLS).collect()))
    # one processed_ts per micro-batch, shared by every sink
    per_batch = table.groupBy("batch_id").agg(F.countDistinct("processed_ts").alias("n")).collect()
    assert all(r.n == 1 for r in per_batch)
    serving = spark.read.parquet(f"{workdir}/out/serving")
    assert serving.count() == table.count() == serving.select("event_id").distinct().count()
    anomalies = VersionedTable(spark, f"{workdir}/out/anomalies").scan()
    assert anomalies.count() == table.filter("is_anomaly").count()
    assert spark.read.json(f"{workdir}/out/bus/anomalies").count() == anomalies.count()

    # (e) valid + dead letters = every bus record
    dlq = spark.read.parquet(f"{workdir}/out/dlq").filter("dlq_reason <> 'type_mismatch'")
    valid_deliveries = valid_events(parse_bus(bus)).count()
    assert valid_deliveries + dlq.count() == bus.count()

    # windowed counts: per-batch partials add up to every valid event, once
    from releaseflow.operators.monitor import windowed_counts_from_partials
    windows = windowed_counts_from_partials(spark, f"{workdir}/out/window_partials")
    assert windows.agg(F.sum("n_events")).first()[0] == table.count()
    assert windows.groupBy("window_start", "source").count().filter("count > 1").count() == 0
    from releaseflow.operators.monitor import windowed_counts
    cols = ["window_start", "window_end", "source", "n_events", "n_anomalies", "n_high_impact"]
    assert Counter(map(tuple, windows.select(*cols).collect())) == \
        Counter(map(tuple, windowed_counts(batch).select(*cols).collect()))
    # one query reads the bus
    assert len(qs["queries"]) == 1

    # (b) a restart on the same checkpoints adds nothing
    qs2 = _run(spark, workdir)
    assert qs2["fanout"].written == {}
    assert VersionedTable(spark, f"{workdir}/out/releases_enriched").scan().count() == table.count()


def test_replayed_batch_does_not_duplicate(spark, workdir):
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"),
                 serving=ParquetServingTarget(f"{workdir}/serving"))
    batch = enrich(releases(spark, SF_SMALL).limit(0).unionByName(releases(spark, SF_SMALL)))
    fan(batch, 7)
    fan(batch, 7)  # at-least-once delivery: same batch again
    assert VersionedTable(spark, f"{workdir}/t").scan().count() == 1000
    assert spark.read.parquet(f"{workdir}/serving").count() == 1000


def test_late_duplicate_is_dropped_by_watermark(spark, workdir):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    early = bus.filter("timestamp < '2024-01-10'")
    late = bus.filter("timestamp >= '2024-01-20'")
    early.coalesce(1).write.parquet(f"{workdir}/landing/f0")
    late.coalesce(1).write.parquet(f"{workdir}/landing/f1")
    # a re-delivery of an old record after the watermark moved on
    early.filter("offset = 2 AND partition = 1").coalesce(1).write.parquet(f"{workdir}/landing/f2")
    src = file_bus(spark, f"{workdir}/landing/*", max_files_per_trigger=1)
    from releaseflow.streaming.job import enriched_stream
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"))
    q = (enriched_stream(src).writeStream.foreachBatch(fan)
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    assert q.awaitTermination(600)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped >= 1
    from releaseflow.operators.monitor import watermark_drops
    report = watermark_drops(spark, q.recentProgress)
    assert report.agg(F.sum("rows_dropped_by_watermark")).first()[0] == dropped
    n = VersionedTable(spark, f"{workdir}/t").scan().count()
    expected = valid_events(parse_bus(early.unionByName(late))).dropDuplicates(["event_id"]).count()
    assert n == expected


def test_streaming_history_equals_batch_window(spark, workdir):
    """Rolling context computed batch by batch in the fan-out equals the window over all rows."""
    from releaseflow.operators.history import hist_context, rolling_zscore
    from releaseflow.operators.rolling import DAY_US
    from releaseflow.streaming.history import StreamingHistory
    from releaseflow.streaming.job import enriched_stream

    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    edges = ["2024-01-01", "2024-01-06", "2024-01-11", "2024-01-16", "2024-01-21", "2024-01-26", "2024-02-01"]
    for i in range(6):
        (bus.filter((F.col("timestamp") >= edges[i]) & (F.col("timestamp") < edges[i + 1]))
            .coalesce(1).write.parquet(f"{workdir}/landing/f{i}"))
    W = 7 * DAY_US
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"),
                 history=StreamingHistory(spark, f"{workdir}/hist_state", W),
                 history_path=f"{workdir}/hist")
    src = file_bus(spark, f"{workdir}/landing/*", max_files_per_trigger=1)
    q = (enriched_stream(src).writeStream.foreachBatch(fan)
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    assert q.awaitTermination(900) and q.exception() is None
    assert len(fan.written) == 6

    got = spark.read.parquet(f"{workdir}/hist")
    valid = enrich(valid_events(parse_bus(bus)).dropDuplicates(["event_id"]))
    exp_ctx = hist_context(valid, window_us=W)
    exp_z = rolling_zscore(valid, window_us=W)
    g = {r.event_id: r for r in got.collect()}
    e1 = {r.event_id: r for r in exp_ctx.collect()}
    e2 = {r.event_id: r for r in exp_z.collect()}
    assert set(g) == set(e1)
    for k, r in g.items():
        assert (r.hist_n, r.hist_min, r.hist_max) == (e1[k].hist_n, e1[k].hist_min, e1[k].hist_max), k
        for c in ("hist_mean", "hist_std", "zscore"):
            a, b = getattr(r, c), getattr(e2[k], c)
            assert (a is None and b is None) or abs(a - b) < 1e-6, (k, c, a, b)


def test_late_first_deliveries_are_kept_and_marked(spark, workdir):
    bus = bus_rows(releases(spark, SF_SMALL)).drop("seq")
    edges = ["2024-01-21", "2024-02-01", "2024-01-11", "2024-01-21", "2024-01-01", "2024-01-11"]
    for i in range(3):  # the newest part lands first
        (bus.filter((F.col("timestamp") >= edges[2 * i]) & (F.col("timestamp") < edges[2 * i + 1]))
            .coalesce(1).write.parquet(f"{workdir}/landing/f{i}"))
    bus.limit(50).coalesce(1).write.parquet(f"{workdir}/landing/f3")  # and some again
    _run(spark, workdir)
    table = VersionedTable(spark, f"{workdir}/out/releases_enriched").scan()
    want = valid_events(parse_bus(bus)).select("event_id").distinct().count()
    assert table.count() == want == table.select("event_id").distinct().count()
    first = table.agg(F.min("batch_id")).first()[0]
    assert table.filter("is_late").count() == table.filter(F.col("batch_id") > first).count() > 0


def test_replay_days_later_adds_no_serving_rows(spark, workdir):
    fan = FanOut(table=VersionedTable(spark, f"{workdir}/t"),
                 serving=ParquetServingTarget(f"{workdir}/serving"))
    batch = enrich(releases(spark, SF_SMALL).limit(200), clock=F.current_timestamp() - F.expr("INTERVAL 2 DAYS"))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    fan(batch, 7)
    fan(batch, 7)
    assert spark.read.parquet(f"{workdir}/serving").count() == 200


def test_nan_is_no_observation(spark):
    from releaseflow.operators.history import hist_context
    rows = [(str(i), "X", float(i) if i != 3 else float("nan"), i) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "event_id string, indicator string, value double, h int").withColumn(
        "kafka_ts", F.timestamp_seconds(F.col("h") * 3600)).withColumn("seq", F.col("h").cast("long"))
    got = {r.event_id: (r.hist_n, r.hist_mean) for r in hist_context(df).collect()}
    assert got["4"] == (2, 1.5) and got["5"] == (3, 7 / 3)


def test_prior_value_follows_the_calendar(spark):
    from releaseflow.operators.history import prior_from_lag
    obs = spark.createDataFrame([("R", "2024-Q1", 1.0), ("R", "2024-11", 3.0), ("R", "2024-Q2", 2.0)],
                                "release_name string, period string, value double")
    got = {r.period: r.prior_value for r in prior_from_lag(obs).collect()}
    assert got == {"2024-Q1": None, "2024-Q2": 1.0, "2024-11": 2.0}


def test_history_of_an_empty_batch_has_every_column(spark, workdir):
    from releaseflow.streaming.history import StreamingHistory

    good = enrich(valid_events(parse_bus(bus_rows(releases(spark, SF_SMALL)).drop("seq"))))
    hist = StreamingHistory(spark, f"{workdir}/hist_state")
    empty = hist.process(good.filter("false"), 0)
    assert empty.count() == 0
    full = hist.process(good.limit(20), 1)
    assert dict(empty.dtypes) == dict(full.dtypes)
