"""Scale-related plan properties that the small fixtures would otherwise hide."""

from pyspark.sql import functions as F

from releaseflow.operators.maintenance import compact
from releaseflow.plans.common import enriched
from releaseflow.sources.table import VersionedTable

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_compaction_splits_a_hot_release(spark, workdir):
    base = enriched(spark, SF_SMALL).drop("seq")
    # one release with ~90 % of the rows
    hot = base.withColumn("release_name", F.when(F.col("offset") % 10 != 0, F.lit("BLS_JOBS_REPORT"))
                          .otherwise(F.col("release_name")))
    t = VersionedTable(spark, f"{workdir}/t")
    t.write_all(hot, replace_partitions=False)
    c = compact(t, f"{workdir}/c", num_partitions=4)
    files = (c.scan().filter(F.col("release_name") == "BLS_JOBS_REPORT")
             .select(F.input_file_name().alias("f")).distinct().count())
    per_dir = (c.scan().filter(F.col("release_name") == "BLS_JOBS_REPORT")
               .select("source", "processing_date").distinct().count())
    assert files > per_dir  # the hot release was written by more than one task per folder


def test_json_is_decoded_once(spark):
    """The validity filter stays above the parse: from_json appears once in the plan."""
    from releaseflow.functions.parse import parse_bus, valid_events
    from releaseflow.plans.common import releases
    from releaseflow.sources.events import bus_rows
    plan = _plan(valid_events(parse_bus(bus_rows(releases(spark, SF_SMALL)))))
    assert plan.count("from_json(") == 1
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)


def _backfilled(spark, root, batches=200):
    """A table of many batches over two days and two sources."""
    rows = spark.range(batches * 4).select(
        F.col("id").cast("string").alias("event_id"), F.concat(F.lit("r"), F.col("id") % 3).alias("release_name"),
        F.expr("timestamp_seconds(1704067200 + 60 * id)").alias("processed_ts"), F.expr("id div 4").alias("batch_id"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("source"),
        F.expr("date_add(date'2024-01-01', int(id % 2))").alias("processing_date"))
    t = VersionedTable(spark, root)
    t.write_all(rows, replace_partitions=False)
    return t


def test_a_zordered_read_lists_files_by_day_not_by_batch(spark, workdir):
    from releaseflow.operators.maintenance import with_newer_batches, zorder
    t = _backfilled(spark, f"{workdir}/t")
    read = with_newer_batches(t, zorder(t, f"{workdir}/z", num_partitions=2))
    assert read.count() == 800 and len(read.inputFiles()) <= 8


def test_compaction_reads_files_by_day_not_by_batch(spark, workdir):
    t = _backfilled(spark, f"{workdir}/t")
    c = compact(t, f"{workdir}/c", num_partitions=2)
    assert c.scan().count() == 800 and c.commits().count() == 200
    assert len(t.scan().inputFiles()) <= 8 and len(c.scan().inputFiles()) <= 8


def test_a_read_as_of_a_time_lists_files_by_day_not_by_batch(spark, workdir):
    t = _backfilled(spark, f"{workdir}/t")
    # Batch 99 ends with row 399, in minute 399 of the first day.
    then = t.as_of_timestamp("2024-01-01 06:39:00")
    assert sorted(int(r[0]) for r in then.select("event_id").collect()) == list(range(400))
    assert len(then.inputFiles()) <= 8
