"""Connected components of an edge table, distributed.

Alternating large-star and small-star steps: each step points every node at the
smallest neighbour it knows; the edge table never grows beyond its first size
and ends as stars around the smallest id of each component. Every step is a
combined-before-shuffle minimum and a join that adaptive execution may split for
hot nodes. Each round is checkpointed in the shared folder; nothing but two
numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releaseflow.session import shared_dir


def saved(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(id, component)`` for every id on an edge; component is the smallest id reachable.

    Null ids and loops are ignored. An empty edge table gives an empty result.
    """
    a, b = F.col(src), F.col(dst)
    e = saved(edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = saved(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = _state(nxt)
        e = nxt
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
