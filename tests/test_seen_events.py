"""Index of seen events: merging, Bloom filter, replay, flat reads."""

import os

from pyspark.sql import functions as F

from releaseflow.streaming.dedup import SeenEvents

SCHEMA = "k string, t long, partition int, offset long"


def _batch(spark, keys, t=0):
    rows = [(k, t + i, 0, i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("kafka_ts", F.timestamp_seconds(F.col("t") + 1_700_000_000))


def _step(seen, batch, n):
    fresh = seen.fresh(batch, n).persist()
    out = sorted(r["k"] for r in fresh.collect())
    seen.commit(fresh, n)
    fresh.unpersist()
    return out


def _files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_first_deliveries_over_many_batches(spark, workdir):
    seen = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=3, merge_runs=2)
    files, folders, told = [], [], set()
    for n in range(14):
        keys = [f"k{i}" for i in range(n * 4, n * 4 + 8)] * 2  # half of them known from the batch before
        if n % 3 == 2:
            keys += ["k0", f"k{n}"]  # known for long
        got = _step(seen, _batch(spark, keys, n), n)
        assert got == sorted(set(keys) - told)
        told |= set(keys)
        files.append(_files(f"{workdir}/seen"))
        folders.append(len(os.listdir(f"{workdir}/seen/recent")))
    assert max(folders) <= 2 * (3 + 1)  # with checksum files; batches past the merge are gone
    runs = [d for d in os.listdir(f"{workdir}/seen/runs") if d.startswith("run=")]
    assert 1 <= len(runs) <= 4
    # a fresh process finds everything again
    again = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=3, merge_runs=2)
    assert [r["k"] for r in again.fresh(_batch(spark, sorted(told) + ["new"]), 14).collect()] == ["new"]


def test_a_replay_finds_the_same_rows(spark, workdir):
    seen = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=2, merge_runs=2)
    for n in range(6):
        batch = _batch(spark, [f"a{n}", f"b{n}", "always"], 10 * n)
        first = _step(seen, batch, n)
        again = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=2, merge_runs=2)
        assert _step(again, batch, n) == first == sorted({f"a{n}", f"b{n}"} | ({"always"} if n == 0 else set()))


def test_an_incomplete_run_is_not_used(spark, workdir):
    seen = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=2, merge_runs=9)
    for n in range(4):
        _step(seen, _batch(spark, [f"k{n}"]), n)
    runs = seen._runs(99)
    assert runs
    os.remove(f"{workdir}/seen/runs/run={'-'.join(map(str, runs[0]))}/_SUCCESS")
    assert runs[0] not in seen._runs(99)


def test_new_keys_read_no_run(spark, workdir):
    seen = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours", merge_batches=2, merge_runs=9)
    for n in range(5):
        _step(seen, _batch(spark, [f"k{n}-{i}" for i in range(50)]), n)
    suspects = {r["k"] for r in seen._suspects(_batch(spark, ["k0-1", "k1-7", *(f"new{i}" for i in range(200))]), 5).collect()}
    assert {"k0-1", "k1-7"} <= suspects and len(suspects) <= 4
    read = []
    plain = seen._slot_paths
    seen._slot_paths = lambda run, slots: (read.extend(slots), plain(run, slots))[1]
    fresh = seen.fresh(_batch(spark, [f"new{i}" for i in range(50)]), 5)
    assert fresh.count() == 50 and len(set(read)) <= 3


def test_late_rows_are_marked_not_dropped(spark, workdir):
    seen = SeenEvents(spark, f"{workdir}/seen", "k", "1 hours")
    _step(seen, _batch(spark, ["now"], 1_000_000), 0)
    rows = {r["k"]: r["is_late"] for r in seen.fresh(
        _batch(spark, ["old"], 0).unionByName(_batch(spark, ["next"], 1_000_001)), 1).collect()}
    assert rows == {"old": True, "next": False}
