"""Table maintenance as Spark jobs (M1-M4): compaction, Z-order clustering, retention.

``compact`` rewrites a table into a new root: rows are range-partitioned and
sorted by the clustering columns, so each output file covers a narrow key
range and Parquet min/max statistics let filters on the first of those columns skip
files. ``zorder`` clusters by several columns alike: each column's value becomes a rank among
approximate quantiles, the bits of the ranks are interleaved, and rows are range-partitioned and
sorted on that code, so a file covers a small range of every column and a filter on any of
them skips most files. ``batch_id`` stays a data column, so as-of reads
on a rewritten root still work. ``with_newer_batches`` reads such a copy together with the batches
that the table got since. ``retention_candidates`` reports the batches
older than the retention horizon; nothing here deletes rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.schema import RETENTION_HOURS, SINK_PARTITION_COLUMNS
from releaseflow.session import setting
from releaseflow.sources.table import VersionedTable

ZORDER_COLUMNS = ("release_name", "source", "processed_ts")
#: Rows, about, that the quantiles are taken from, and bits of a column's rank.
QUANTILE_ROWS, RANK_BITS = 20_000, 6


def compact(table: VersionedTable, target_root: str,
            cluster_by: tuple[str, ...] = ("release_name", "source"),
            num_partitions: int | None = None) -> VersionedTable:
    """Rewrite ``table`` into ``target_root`` with few, clustered files."""
    spark = table.spark
    df = table.scan()
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges start with the folder columns, so a task writes to few folders; event_id splits a hot
    # release over several ranges.
    order = [*SINK_PARTITION_COLUMNS, *(c for c in cluster_by if c not in SINK_PARTITION_COLUMNS),
             "processed_ts", "event_id"]
    clustered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    target = VersionedTable(spark, target_root)
    (clustered.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*SINK_PARTITION_COLUMNS)
        .parquet(target.data_path))
    target.record_commits(table.commits())
    return target


def quantile_bounds(df: DataFrame, columns: tuple[str, ...], bits: int = RANK_BITS,
                    id_col: str = "event_id") -> dict[str, list]:
    """Per column at most ``2 ** bits - 1`` ascending values that cut the rows into about equal shares.

    They come from about ``QUANTILE_ROWS`` rows drawn by a hash of the id. They only decide
    where rows lie, never which rows there are.
    """
    rate = min(1.0, QUANTILE_ROWS / max(1, df.count()))
    drawn = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    rows = df.filter(drawn).select(*columns).collect()
    most, bounds = (1 << bits) - 1, {}
    for k, c in enumerate(columns):
        values = sorted(r[k] for r in rows if r[k] is not None)
        distinct = sorted(set(values))
        if len(distinct) > most:
            distinct = sorted({values[len(values) * q // (most + 1)] for q in range(1, most + 1)})
        bounds[c] = distinct
    return bounds


def z_code(bounds: dict[str, list], bits: int = RANK_BITS) -> Column:
    """Ranks of the columns among their bounds with their bits interleaved, first column first."""
    ranks = []
    for c, values in bounds.items():
        below = [F.when(F.col(c) >= F.lit(v), F.lit(1)).otherwise(F.lit(0)) for v in values]
        rank = sum(below[1:], below[0]) if below else F.lit(0)
        # A column of few values uses the high bits too.
        ranks.append(F.floor(rank * F.lit((1 << bits) - 1) / F.lit(max(1, len(values)))).cast("long"))
    code = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            place = bit * len(ranks) + len(ranks) - 1 - k
            code = code.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), place))
    return code


def zorder(table: VersionedTable, target_root: str, columns: tuple[str, ...] = ZORDER_COLUMNS,
           num_partitions: int | None = None) -> VersionedTable:
    """Rewrite ``table`` into ``target_root`` in Z-order of ``columns``.

    Folders would split the table by source and day first, so all columns are stored in the files.
    """
    df = table.scan()
    n = num_partitions or int(table.spark.conf.get("spark.sql.shuffle.partitions"))
    coded = df.withColumn("_z", z_code(quantile_bounds(df, columns)))
    order = ["_z", "processed_ts", "event_id"]  # the last two split a cell that holds many rows
    clustered = coded.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_z")
    target = VersionedTable(table.spark, target_root)
    with setting(table.spark, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):  # INT96 has no statistics
        clustered.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target.data_path)
    # The record comes last: it says which batches the copy holds.
    copied = target.scan().select("batch_id").distinct()
    target.record_commits(table.commits().join(copied, "batch_id", "left_semi"))
    return target


def with_newer_batches(table: VersionedTable, copy: VersionedTable) -> DataFrame:
    """Rows of a rewritten copy, and of the batches that the table got after the copy's last."""
    last = copy.commits().agg(F.max("batch_id")).first()[0]
    if last is None:
        return table.scan()
    newer = table.scan().filter(F.col("batch_id") > F.lit(last))
    return copy.scan().unionByName(newer, allowMissingColumns=True)


def retention_candidates(table: VersionedTable, retain_hours: int = RETENTION_HOURS,
                         as_of: datetime | str | None = None) -> DataFrame:
    """Batches committed before (as_of - retain_hours), never the newest version."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    horizon = now - F.make_interval(hours=F.lit(retain_hours))
    commits = table.commits()
    newest = commits.agg(F.max("batch_id").alias("v")).scalar()
    return (commits.filter((F.col("commit_ts") < horizon) & (F.col("batch_id") < newest))
            .select("batch_id", "commit_ts", "num_rows"))
