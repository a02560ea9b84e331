"""Catalog lookups, duplicate handling and table-integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width limits of the serving table's text columns.
COLUMN_WIDTHS = {"source": 20, "release_name": 60, "indicator": 60, "period": 20}
REQUIRED_COLUMNS = ["event_id", "source", "release_name", "indicator", "period"]


def with_catalog(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Inner join to the release catalog. The catalog has a fixed 13 rows, so it is
    broadcast; events with names outside it drop out (see ``unknown_releases``)."""
    cat = catalog.select("release_name", "indicator", "source", "frequency")
    ev = events.drop("indicator", "source", "frequency")
    return ev.join(F.broadcast(cat), on="release_name", how="inner")


def unknown_releases(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """Events whose release_name is not in the catalog (anti join, broadcast side fixed)."""
    return events.join(F.broadcast(catalog.select("release_name")), on="release_name", how="left_anti")


def first_delivery(events: DataFrame, key: str = "event_id",
                   order: tuple[str, ...] = ("kafka_ts", "partition", "offset")) -> DataFrame:
    """One row per key: the earliest delivery. ``row_number() = 1`` is planned as a
    ``WindowGroupLimit`` before the shuffle, so a hot duplicated key is cut to one
    row per map task before it moves."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc() for c in order])
    return events.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


#: Text forms of a UUID that a database accepts for a UUID column.
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def violations(widths: dict[str, int] | None = None, required: list[str] | None = None,
               id_pattern: str | None = None) -> Column:
    """What a serving table would refuse about a row: ``null:column``, ``wide:column``, ``form:event_id``."""
    found = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in (REQUIRED_COLUMNS if required is None else required)]
    found += [F.when(F.length(F.col(c)) > w, F.lit(f"wide:{c}"))
              for c, w in (COLUMN_WIDTHS if widths is None else widths).items()]
    if id_pattern:
        found.append(F.when(~F.col("event_id").rlike(id_pattern), F.lit("form:event_id")))
    return F.filter(F.array(*found), lambda v: v.isNotNull())


def quarantine_split(df: DataFrame, **limits) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the constraints of ``violations``, and the others with their ``violations``."""
    marked = df.withColumn("violations", violations(**limits))
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def constraint_check(df: DataFrame) -> DataFrame:
    """One-row report of constraint violations: null required columns, over-wide text,
    duplicate event ids. One shuffle (by event_id, partially aggregated map-side)."""
    too_wide = None
    for c, w in COLUMN_WIDTHS.items():
        cond = F.length(F.col(c)) > w
        too_wide = cond if too_wide is None else too_wide | cond
    per_id = df.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("c"),
        *[F.sum(_flag(F.col(c).isNull())).alias(f"n_null_{c}") for c in REQUIRED_COLUMNS],
        F.sum(_flag(F.coalesce(too_wide, F.lit(False)))).alias("n_too_wide"))
    has_id = F.col("event_id").isNotNull()
    return per_id.agg(
        F.sum("c").cast("long").alias("n_rows"),
        *[F.sum(f"n_null_{c}").cast("long").alias(f"n_null_{c}") for c in REQUIRED_COLUMNS],
        F.sum("n_too_wide").cast("long").alias("n_too_wide"),
        F.sum(_flag(has_id & (F.col("c") > 1))).cast("long").alias("n_duplicate_ids"),
        F.sum(F.when(has_id, F.col("c") - 1).otherwise(F.lit(0))).cast("long").alias("n_duplicate_rows"))

