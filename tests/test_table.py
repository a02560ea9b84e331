"""Versioned table: idempotent batch writes, as-of reads, history, compaction, retention."""

from pyspark.sql import functions as F

from releaseflow.operators.maintenance import compact, retention_candidates
from releaseflow.plans.common import enriched
from releaseflow.sources.table import VersionedTable

from conftest import SF_SMALL


def _batches(spark):
    df = enriched(spark, SF_SMALL).drop("seq", "batch_id").withColumn("b", F.expr("cast(offset div 100 as int)"))
    return df


def test_replay_is_idempotent(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    df = _batches(spark)
    b0 = df.filter("b = 0").drop("b")
    n1 = t.write_batch(b0, 0, "2024-01-01 00:00:00")
    # replay of batch 0 computed with another processing date must replace, not add
    n2 = t.write_batch(b0.withColumn("processing_date", F.lit("2030-01-01").cast("date")), 0, "2024-01-01 00:00:00")
    assert n1 == n2 > 0
    assert t.scan().count() == n1
    assert t.scan().select("processing_date").distinct().collect()[0][0].year == 2030


def test_as_of_and_history(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    df = _batches(spark)
    for b in range(3):
        t.write_batch(df.filter(F.col("b") == b).drop("b"), b, f"2024-01-0{b + 1} 00:00:00")
    sizes = [t.as_of_version(v).count() for v in range(3)]
    assert sizes[0] < sizes[1] < sizes[2] == t.scan().count()
    # version v is a subset of version v + 1
    v1 = t.as_of_version(1).select("event_id")
    assert v1.subtract(t.as_of_version(2).select("event_id")).count() == 0
    assert t.as_of_timestamp("2024-01-02 12:00:00").count() == sizes[1]
    h = t.history(2).collect()
    assert [r.version for r in h] == [2, 1]


def test_compaction_preserves_rows_and_retention(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    df = _batches(spark)
    for b in range(3):
        t.write_batch(df.filter(F.col("b") == b).drop("b"), b, f"2024-01-0{b + 1} 00:00:00")
    c = compact(t, f"{workdir}/c", num_partitions=2)
    cols = ["event_id", "value", "surprise_pct", "batch_id", "source", "processing_date"]
    assert t.scan().select(*cols).exceptAll(c.scan().select(*cols)).count() == 0
    assert c.scan().select(*cols).exceptAll(t.scan().select(*cols)).count() == 0
    assert c.as_of_version(1).count() == t.as_of_version(1).count()
    cand = [r.batch_id for r in retention_candidates(t, 24, "2024-01-03 12:00:00").collect()]
    assert cand == [0] or sorted(cand) == [0, 1]
    assert t.scan().filter(F.col("batch_id").isin(cand)).count() > 0  # a report: nothing is deleted


def test_concurrent_batch_writes_count_their_own_rows(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor
    df = _batches(spark).drop("b")
    small, big = df.limit(10), df
    t1, t2 = VersionedTable(spark, f"{workdir}/a"), VersionedTable(spark, f"{workdir}/b")
    with ThreadPoolExecutor(2) as pool:
        f1 = pool.submit(t1.write_batch, small, 5, "2024-01-01 00:00:00")
        f2 = pool.submit(t2.write_batch, big, 5, "2024-01-01 00:00:00")
        n1, n2 = f1.result(), f2.result()
    assert (n1, n2) == (10, big.count())
    assert t1.commits().first().num_rows == 10


def _groups_read(path, column, low, high):
    """Share of row groups whose statistics allow values of ``column`` in [low, high]."""
    import glob

    import pyarrow.parquet as pq
    total = read = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            read += stats.min <= high and stats.max >= low
    return read / total


def test_zorder_prunes_by_each_column_alone(spark, workdir):
    import datetime

    from releaseflow.operators.maintenance import zorder
    t = VersionedTable(spark, f"{workdir}/t")
    rows = enriched(spark, "/root/testdata/sf0.01").drop("seq", "batch_id")
    t.write_batch(rows, 0, "2024-01-01 00:00:00")
    z = zorder(t, f"{workdir}/z", num_partitions=32)
    cols = ["event_id", "value", "surprise_pct", "batch_id", "source", "processing_date", "processed_ts"]
    assert t.scan().select(*cols).exceptAll(z.scan().select(*cols)).count() == 0
    assert z.scan().count() == t.scan().count()
    data = f"{workdir}/z/data"
    names = sorted({r[0] for r in rows.select("release_name").distinct().collect()})
    assert max(_groups_read(data, "release_name", n, n) for n in names) < 0.5
    sources = {r[0]: r[1] for r in rows.groupBy("source").count().collect()}
    rare = min(sources, key=sources.get)
    assert _groups_read(data, "source", rare, rare) < 0.5
    for day in (3, 15, 28):
        low = datetime.datetime(2024, 1, day, tzinfo=datetime.timezone.utc)
        assert _groups_read(data, "processed_ts", low, low + datetime.timedelta(days=1)) < 0.5


def test_zorder_splits_a_hot_cell_and_takes_nulls(spark, workdir):
    from releaseflow.operators.maintenance import zorder
    t = VersionedTable(spark, f"{workdir}/t")
    rows = enriched(spark, SF_SMALL).drop("seq", "batch_id").withColumn("source", F.lit("one")).withColumn(
        "release_name", F.when(F.col("event_id").cast("long") % 7 > 0, F.lit("hot")))
    t.write_batch(rows, 0, "2024-01-01 00:00:00")
    z = zorder(t, f"{workdir}/z", columns=("release_name", "source"), num_partitions=8)
    sizes = [r["count"] for r in z.scan().groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == rows.count() and max(sizes) < 0.3 * sum(sizes)


def test_optimized_reads_add_newer_batches(spark, workdir):
    from releaseflow.operators.maintenance import with_newer_batches, zorder
    t = VersionedTable(spark, f"{workdir}/t")
    df = _batches(spark)
    t.write_batch(df.filter("b = 0").drop("b"), 0, "2024-01-01 00:00:00")
    z = zorder(t, f"{workdir}/z", num_partitions=2)
    t.write_batch(df.filter("b = 1").drop("b"), 1, "2024-01-02 00:00:00")
    ids = [r[0] for r in with_newer_batches(t, z).select("event_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in t.scan().select("event_id").collect()) and len(set(ids)) == len(ids)


def _folders(path):
    import os
    return sorted(os.path.relpath(d, path) for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files))


def test_a_replay_on_another_day_leaves_no_old_folder(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    rows = _batches(spark).drop("b").limit(60)
    other = rows.withColumn("processing_date", F.lit("2030-01-01").cast("date"))
    t.write_batch(rows, 3, "2024-01-01 00:00:00")
    t.write_batch(other, 3, "2024-01-01 00:00:00")  # the whole batch again
    assert t.scan().count() == 60 and all("2030-01-01" in f for f in _folders(t.data_path))
    import os
    os.makedirs(f"{t.root}/_writing/batch_id=4")  # an attempt that ended before its commit
    broken = rows.withColumn("batch_id", F.lit(4).cast("long"))
    (broken.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "processing_date", "batch_id").parquet(t.data_path))
    t.write_batch(other, 4, "2024-01-02 00:00:00")
    assert t.scan().filter("batch_id = 4").count() == 60
    assert all("2030-01-01" in f for f in _folders(t.data_path))
    assert [r.batch_id for r in t.commits().orderBy("batch_id").collect()] == [3, 4]


def test_a_scan_of_some_days_lists_only_their_folders(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    df = enriched(spark, SF_SMALL).drop("seq")
    t.write_all(df)
    part = t.scan(sources=["BLS"], since="2024-01-20", until="2024-01-22")
    files = part.inputFiles()
    assert files and all("source=BLS" in f and any(f"processing_date=2024-01-2{d}" in f for d in (0, 1, 2)) for f in files)
    want = t.scan().filter("source = 'BLS' AND processing_date BETWEEN '2024-01-20' AND '2024-01-22'")
    assert sorted(r[0] for r in part.select("event_id").collect()) == sorted(
        r[0] for r in want.select("event_id").collect())
    none = t.scan(sources=["nobody"])
    assert none.count() == 0 and none.columns == t.scan().columns


def test_commit_rows_share_files(spark, workdir):
    import os
    t = VersionedTable(spark, f"{workdir}/t")
    for n in range(6):
        t.record_commits(spark.createDataFrame([(n, n)], "batch_id long, num_rows long").select(
            F.current_timestamp().alias("commit_ts"), F.lit("x").alias("operation"), "num_rows", "batch_id"))
    assert [r.version for r in t.history(10).collect()] == [5, 4, 3, 2, 1, 0]
    assert len([d for d in os.listdir(f"{t.commits_path}/bucket=0") if d.startswith("version=")]) == 2


def test_a_micro_batch_writes_one_file_a_folder(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    t.write_batch(_batches(spark).drop("b").repartition(40), 0, "2024-01-01 00:00:00")
    files = t.scan().inputFiles()
    assert len(files) == len(_folders(t.data_path))


def _many_batches(spark, batches, days=2):
    return spark.range(batches * 4).select(
        F.col("id").cast("string").alias("event_id"), F.lit(1.0).alias("value"),
        F.expr(f"timestamp_seconds(1704067200 + 86400 * (id % {days}))").alias("processed_ts"),
        F.expr("if(id % 8 = 7, null, concat('s', id % 2))").alias("source"),
        F.expr(f"date_add(date'2024-01-01', int(id % {days}))").alias("processing_date"),
        F.expr("id div 4").alias("batch_id"))


def test_a_backfill_writes_files_by_day_not_by_batch(spark, workdir):
    few, many = VersionedTable(spark, f"{workdir}/few"), VersionedTable(spark, f"{workdir}/many")
    few.write_all(_many_batches(spark, 20), replace_partitions=False)
    many.write_all(_many_batches(spark, 400), replace_partitions=False)
    files = len(many.scan().inputFiles())
    assert files == len(few.scan().inputFiles()) <= 6
    assert many.scan().count() == 1600 and many.as_of_version(9).count() == 40
    assert many.commits().count() == 400
    assert many.scan().filter("source IS NULL").count() == 200
    both = many.scan(sources=["s1"], since="2024-01-02")
    assert sorted(r[0] for r in both.select("event_id").collect()) == sorted(
        r[0] for r in many.scan().filter("source = 's1' AND processing_date >= '2024-01-02'").select("event_id").collect())


def _values(t):
    return sorted((r.event_id, r.batch_id, r.value) for r in t.scan().collect())


def test_a_backfilled_batch_is_replaced_by_its_replay(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    rows = _many_batches(spark, 6)
    t.write_all(rows)
    before = _values(t)
    for value in (2.0, 3.0):  # the replay, and a replay of that
        again = rows.filter("batch_id = 3").drop("batch_id").withColumn("value", F.lit(value)).withColumn(
            "processing_date", F.lit("2030-01-01").cast("date"))
        t.write_batch(again, 3, "2024-02-01 00:00:00")
        assert _values(t) == [(e, b, value if b == 3 else v) for e, b, v in before]
    t.write_batch(rows.drop("batch_id").limit(2), 9, "2024-02-02 00:00:00")
    assert t.scan().count() == 26 and t.scan().columns == VersionedTable(spark, t.root).scan().columns
    part = t.scan(since="2030-01-01")
    assert {r.batch_id for r in part.collect()} == {3}


def test_a_later_backfill_replaces_what_it_holds(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    rows = _many_batches(spark, 6)
    t.write_batch(rows.filter("batch_id = 1").drop("batch_id"), 1, "2024-01-01 00:00:00")
    t.write_all(rows.filter("batch_id < 4"))
    assert _values(t) == sorted((r.event_id, r.batch_id, 1.0) for r in rows.filter("batch_id < 4").collect())
    some = rows.filter("batch_id >= 3 AND (source = 's1' OR source IS NULL)").withColumn("value", F.lit(5.0))
    for _ in range(2):
        t.write_all(some)
        new = {r.event_id: 5.0 for r in some.collect()}
        old = {r.event_id: 1.0 for r in rows.filter("batch_id < 4").collect()}
        assert {e: v for e, _, v in _values(t)} == {**old, **new} and len(_values(t)) == len({**old, **new})
    t.write_all(rows.filter("batch_id = 0"), replace_partitions=False)
    assert t.scan().count() == 4
