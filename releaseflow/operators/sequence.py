"""Order-dependent operators that stay parallel under hot keys.

``lag(x) over (partition by key order by ts)`` puts every row of a key into
one task. When a single key can hold a third of the data that task is the
whole job. ``bucketed_lag`` computes the same value with windows that are
partitioned by (key, time bucket) instead:

1. lag inside each (key, bucket) window;
2. one ``max_by`` per (key, bucket) gives the bucket's last row
   (hash aggregate with map-side combine: no hot group moves);
3. a window over those per-bucket tails (one row per bucket, small) gives
   the previous non-empty bucket's last row;
4. the first row of each bucket takes that tail, the others their in-bucket lag.

Step 4 joins on (key, bucket), the partitioning and order step 1 already
produced, so the large side is shuffled and sorted exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 3600


def time_bucket(ts: Column | str, bucket_seconds: int) -> Column:
    """Integer bucket id of a timestamp; monotone in time."""
    return F.floor(F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
                   / F.lit(bucket_seconds * 1_000_000))


def bucketed_lag(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                 value_cols: Sequence[str], out_cols: Sequence[str],
                 bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``out_cols[i] = lag(value_cols[i]) over (partition by keys order by ts, tiebreak)``.

    Exact for any data; no window partition is larger than one (key, bucket).
    """
    keys, tiebreak = list(keys), list(tiebreak)
    order = [ts_col] + tiebreak
    b = "_lag_bucket"
    base = df.withColumn(b, time_bucket(ts_col, bucket_seconds))

    w_in = Window.partitionBy(*keys, b).orderBy(*order)
    d = base.withColumn("_lag_first", F.row_number().over(w_in) == 1)
    for v, o in zip(value_cols, out_cols):
        d = d.withColumn(f"_lag_in_{o}", F.lag(v).over(w_in))

    tail = F.struct(*[F.col(v).alias(v) for v in value_cols])
    tails = (base.groupBy(*keys, b)
             .agg(F.max_by(tail, F.struct(*order)).alias("_tail")))
    w_b = Window.partitionBy(*keys).orderBy(b)
    prev = tails.select(*keys, b, F.lag("_tail").over(w_b).alias("_prev_tail"))

    # Co-partitioned sort-merge join: the rows are already hashed and sorted by
    # (keys, bucket) for the window, so only the small per-bucket side moves. No
    # broadcast: the number of (key, bucket) pairs is not bounded in general.
    out = d.join(prev.hint("merge"), on=keys + [b], how="left")
    for v, o in zip(value_cols, out_cols):
        out = out.withColumn(
            o, F.when(F.col("_lag_first"), F.col("_prev_tail")[v]).otherwise(F.col(f"_lag_in_{o}")))
    drop = [b, "_lag_first", "_prev_tail"] + [f"_lag_in_{o}" for o in out_cols]
    return out.drop(*drop)


def bucketed_row_number(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str], out_col: str,
                        bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Add ``out_col = row_number() over (partition by keys order by ts, tiebreak)``.

    A row's number is its number in its bucket plus the rows of the key's earlier buckets.
    """
    keys, b = list(keys), "_num_bucket"
    base = df.withColumn(b, time_bucket(ts_col, bucket_seconds))
    inside = F.row_number().over(Window.partitionBy(*keys, b).orderBy(ts_col, *tiebreak))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    sizes = base.groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_size")).select(
        *keys, b, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    out = base.withColumn("_inside", inside).join(sizes.hint("merge"), on=[*keys, b], how="left")
    return out.withColumn(out_col, F.col("_inside") + F.col("_before")).drop(b, "_inside", "_before")


def asof_last(left: DataFrame, right: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
              value_cols: Sequence[str], bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """As-of join: each left row with ``value_cols`` of the newest right row of its key at or before its time.

    Both sides run through one union, carried as a last known value: inside a (key, bucket)
    by a window, across buckets by a window over one row per bucket. Of right rows at the same time
    the last by ``tiebreak`` counts; left rows without a match, or with a null key, get nulls.
    """
    keys, b, known = list(keys), "_asof_bucket", "_asof_known"
    value = F.struct(*[F.col(v).alias(v) for v in value_cols])
    spare = [c for c in left.columns if c not in (*keys, ts_col)]
    carry = [F.struct(*[F.col(c) for c in spare]).alias("_left")]
    events = left.select(*keys, ts_col, *carry, F.lit(1).alias("_side"))
    facts = right.select(*keys, ts_col, value.alias(known), F.struct(*tiebreak).alias("_tie"), F.lit(0).alias("_side"))
    both = events.unionByName(facts, allowMissingColumns=True).withColumn(b, time_bucket(ts_col, bucket_seconds))

    so_far = (Window.partitionBy(*keys, b).orderBy(ts_col, "_side", "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = both.withColumn("_inside", F.last(known, ignorenulls=True).over(so_far)).filter("_side = 1")
    last = F.max_by(known, F.when(F.col("_side") == 0, F.struct(ts_col, "_tie")))
    earlier = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    tails = both.groupBy(*keys, b).agg(last.alias("_tail")).select(
        *keys, b, F.last("_tail", ignorenulls=True).over(earlier).alias("_before"))
    out = rows.join(tails.hint("merge"), on=[*keys, b], how="left")
    some = F.lit(True)
    for k in keys:
        some = some & F.col(k).isNotNull()
    found = F.when(some, F.coalesce("_inside", "_before"))
    return out.withColumn("_found", found).select(
        *keys, ts_col, "_left.*", *[F.col("_found")[v].alias(v) for v in value_cols])
