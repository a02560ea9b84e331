"""Exact rolling statistics per key that stay parallel under hot keys.

``avg(v) over (partition by key order by t range between W preceding and 1 preceding)``
sorts every row of a key in one task. Here the frame [t - W, t) of a row in
time bucket c (bucket width B, W = m * B) is split into three parts:

* the prefix of bucket c before t        - window over (key, bucket)
* the full buckets c-m+1 .. c-1          - nodes of a tree of bucket summaries
* the suffix of bucket c-m from t - W    - a *probe* row placed in bucket c-m,
                                            same window partition as that bucket

No window partition holds more than one bucket of one key (plus probes), so
a key with a third of all rows is spread over all its buckets.

The tree has a node for every ``FAN`` buckets, every ``FAN`` of those and so on. A
run of buckets is covered by at most ``2 * (FAN - 1)`` nodes of each level (42 for
a year of hours), found by arithmetic. Runs and nodes meet in a join on (key,
level, node), so neither a key nor a long window gathers in one task.

Parts carry count, exact decimal sum, sum of squared deviations from their own mean
(m2), least and greatest. They combine exactly but for m2, which is the sum over parts of
``m2 + n * (mean of the part - mean of all)^2``: only non-negative terms, so a series
of narrow spread around a large level loses nothing to cancellation.

``rolling_rows_stats`` does the same for a ``rows between n preceding and 1
preceding`` frame: the in-bucket part is a window, the part before the bucket
comes from the last n rows of up to n preceding non-empty buckets
(``WindowGroupLimit`` + ``collect_list`` of at most n values per bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

STAT_NAMES = ("n", "dsum", "m2", "min", "max")
# Exact sums: values as DECIMAL(35, 9). Adding three window parts stays within 38
# digits, so Spark never drops scale, and the mean (dsum as double / n) is the same
# double in every engine that converts decimals to doubles with correct rounding.
DEC = "decimal(35,9)"
#: log2 of the buckets or nodes that a node of the next level holds.
FAN_BITS = 2


def _dec(c: Column) -> Column:
    return c.cast(DEC)


def _observed(value_col: str) -> Column:
    """The value as a double; NaN is no observation, in counts as in sums."""
    v = F.col(value_col).cast("double")
    return F.when(~F.isnan(v), v)


def _stats(v: Column, w) -> list[Column]:
    """Statistics of ``v`` over a window, in the order of ``STAT_NAMES``."""
    n = F.count(v).over(w)
    return [n, _dec(F.sum(_dec(v)).over(w)), F.var_pop(v).over(w) * n, F.min(v).over(w), F.max(v).over(w)]


def _summary(v: Column) -> list[Column]:
    """The same as aggregates of a group."""
    n = F.count(v)
    return [c.alias(s) for c, s in zip((n, _dec(F.sum(_dec(v))), F.var_pop(v) * n, F.min(v), F.max(v)), STAT_NAMES)]


def mean_of(n: Column, dsum: Column) -> Column:
    return dsum.cast("double") / n


def spread_about(mean: Column, n: Column, dsum: Column, m2: Column) -> Column:
    """Sum of squared deviations of a part's values from ``mean``; null for a part without values."""
    off = mean_of(n, dsum) - mean
    return F.when(n > 0, m2 + n * off * off)


def _merged(groups, *keep: Column) -> DataFrame:
    """Summaries of one group as one."""
    part = F.when(F.col("n") > 0, F.struct("n", "dsum", "m2"))
    both = groups.agg(*keep, F.sum("n").alias("n"), _dec(F.sum("dsum")).alias("dsum"),
                      F.collect_list(part).alias("_parts"), F.min("min").alias("min"), F.max("max").alias("max"))
    mean = mean_of(F.col("n"), F.col("dsum"))
    m2 = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + spread_about(mean, p["n"], p["dsum"], p["m2"]))
    return both.withColumn("m2", m2).drop("_parts")


def bucket_summaries(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                     bucket_us: int = DAY_US) -> DataFrame:
    """Per (key, bucket): n, dsum, m2, min, max of the value (mergeable partials)."""
    return (df.groupBy(*keys, F.floor(F.unix_micros(F.col(ts_col)) / F.lit(bucket_us)).alias("bucket"))
            .agg(*_summary(_observed(value_col))).select(*keys, "bucket", *STAT_NAMES))


def merge_summaries(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge partial summaries of the same (key, bucket)."""
    return _merged(parts.groupBy(*keys, "bucket")).select(*keys, "bucket", *STAT_NAMES)


def tree_levels(span: int) -> int:
    """Levels of the tree that cover any run of ``span`` buckets in a few nodes each."""
    levels = 1
    while (1 << (FAN_BITS * levels)) <= span:
        levels += 1
    return levels


def summary_tree(summaries: DataFrame, keys: Sequence[str], levels: int) -> DataFrame:
    """``(keys, level, node)`` and the summary of the node's buckets; level 0 has the buckets themselves."""
    up = summaries.filter("n > 0").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    up = up.withColumn("node", F.expr(f"shiftright(bucket, {FAN_BITS} * level)"))
    return _merged(up.groupBy(*keys, "level", "node"))


def covering_nodes(low: Column, high: Column, levels: int) -> Column:
    """Fewest nodes (level, node) that hold the buckets low .. high - 1 and no others."""
    fan = 1 << FAN_BITS

    def run(level: int, a: Column, b: Column) -> Column:
        nodes = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(nodes, lambda x: F.struct(F.lit(level).alias("level"), x.alias("node")))

    def at(level: int) -> tuple[Column, Column]:  # first node that begins inside, first that ends outside
        size = F.lit(1 << (FAN_BITS * level)).cast("long")
        return F.floor((low + size - 1) / size), F.floor(high / size)

    out = []
    for level in range(levels):
        a, b = at(level)
        if level == levels - 1:
            out.append(run(level, a, b))
            break
        up_a, up_b = at(level + 1)
        whole = up_a <= up_b
        out.append(run(level, a, F.when(whole, up_a * fan).otherwise(b)))
        out.append(run(level, F.when(whole, up_b * fan).otherwise(b), b))
    return F.concat(*out)


def _full_buckets(spans: DataFrame, summaries: DataFrame, keys: list[str], bucket: str, m: int) -> DataFrame:
    """For each (key, bucket c) of ``spans``: the summary of buckets c-m+1 .. c-1 as ``_mid_*``."""
    levels = tree_levels(m - 1)
    tree = summary_tree(summaries, keys, levels)
    c = F.col(bucket)
    needed = spans.select(*keys, bucket, F.inline(covering_nodes(c - (m - 1), c, levels)))
    found = needed.join(tree, on=[*keys, "level", "node"])
    merged = _merged(found.groupBy(*keys, bucket))
    return merged.select(*keys, bucket, *[F.col(s).alias(f"_mid_{s}") for s in STAT_NAMES])


def rolling_range_stats(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                        id_cols: Sequence[str], window_us: int, bucket_us: int = HOUR_US,
                        prefix: str = "hist_", target_col: str | None = None,
                        summaries: DataFrame | None = None) -> DataFrame:
    """Add ``{prefix}n, sum, dsum`` (the exact decimal sum), ``m2, min, max`` of ``value_col`` over rows of the same
    key with ts in [ts - window_us, ts - 1us]. ``id_cols`` must identify a row.

    Incremental use (streaming): ``target_col`` marks the rows to compute (the
    others are context) and ``summaries`` (key, bucket, n, dsum, m2, min,
    max) replaces the per-bucket aggregate of ``df`` for the full buckets, so
    ``df`` only needs the raw rows of each target's own bucket and of the
    bucket where its window starts.
    """
    if window_us % bucket_us:
        raise ValueError("window_us must be a multiple of bucket_us")
    keys, id_cols = list(keys), list(id_cols)
    m = window_us // bucket_us
    T, B, V, P = "_rr_t", "_rr_b", "_rr_v", "_rr_probe"
    d = (df.withColumn(T, F.unix_micros(F.col(ts_col)))
           .withColumn(B, F.floor(F.col(T) / F.lit(bucket_us)))
           .withColumn(V, _observed(value_col)))

    own = d.withColumn(P, F.lit(False))
    targets = d if target_col is None else d.filter(F.col(target_col))
    probes = targets.select(*keys, *id_cols, (F.col(T) - F.lit(window_us)).alias(T),
                      (F.col(B) - F.lit(m)).alias(B), F.lit(None).cast("double").alias(V),
                      F.lit(True).alias(P))
    u = own.unionByName(probes, allowMissingColumns=True)

    w_pre = Window.partitionBy(*keys, B).orderBy(F.col(T)).rangeBetween(Window.unboundedPreceding, -1)
    w_suf = (Window.partitionBy(*keys, B).orderBy(F.col(T).desc())
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    v = F.col(V)
    pre_cols = [c.alias(f"_pre_{s}") for c, s in zip(_stats(v, w_pre), STAT_NAMES)]
    suf_cols = [c.alias(f"_suf_{s}") for c, s in zip(_stats(v, w_suf), STAT_NAMES)]

    # Windows first, over data and probe rows together; then split the roles.
    both = u.select("*", *pre_cols, *suf_cols)
    own_rows = ~F.col(P) if target_col is None else (~F.col(P) & F.col(target_col))
    rows = both.filter(own_rows).select(*d.columns, *[f"_pre_{s}" for s in STAT_NAMES])
    suffix = both.filter(F.col(P)).select(*keys, *id_cols, *[f"_suf_{s}" for s in STAT_NAMES])

    if m > 1:
        if summaries is None:
            summaries = bucket_summaries(d, keys, ts_col, V, bucket_us)
        spans = (targets.select(*keys, B).distinct() if target_col is not None
                 else summaries.select(*keys, F.col("bucket").alias(B)))
        rows = rows.join(_full_buckets(spans, summaries, keys, B, m).hint("merge"), on=keys + [B], how="left")
    else:
        kinds = dict(zip(STAT_NAMES, ("long", DEC, "double", "double", "double")))
        rows = rows.select("*", *[F.lit(None).cast(kinds[s]).alias(f"_mid_{s}") for s in STAT_NAMES])

    out = rows.join(suffix, on=keys + id_cols, how="left")
    return out.select(*df.columns, *combined([f"_{p}_" for p in ("pre", "mid", "suf")], prefix))


def combined(parts: Sequence[str], prefix: str) -> list[Column]:
    """Statistics of several parts together, given the prefixes of the parts' columns."""
    def total(s: str, zero: Column) -> Column:
        out = zero
        for p in parts:
            out = out + F.coalesce(F.col(f"{p}{s}"), zero)
        return out

    n = total("n", F.lit(0).cast("long"))
    dsum = _dec(total("dsum", F.lit(0).cast(DEC)))
    mean = mean_of(n, dsum)
    m2 = F.lit(0.0)
    for p in parts:
        m2 = m2 + F.coalesce(spread_about(mean, *(F.col(f"{p}{s}") for s in ("n", "dsum", "m2"))), F.lit(0.0))
    return [n.cast("long").alias(f"{prefix}n"),
            F.when(n > 0, dsum.cast("double")).alias(f"{prefix}sum"),
            F.when(n > 0, dsum).alias(f"{prefix}dsum"),
            F.when(n > 0, m2).alias(f"{prefix}m2"),
            F.least(*(F.col(f"{p}min") for p in parts)).alias(f"{prefix}min"),
            F.greatest(*(F.col(f"{p}max") for p in parts)).alias(f"{prefix}max")]


def rolling_rows_stats(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                       value_col: str, n_rows: int, bucket_us: int = HOUR_US,
                       prefix: str = "obs_") -> DataFrame:
    """Add ``{prefix}n, sum, dsum, m2, min, max`` of ``value_col`` over the ``n_rows`` rows of
    the same key that precede each row in (ts, tiebreak) order."""
    keys, tiebreak = list(keys), list(tiebreak)
    T, B, V = "_ro_t", "_ro_b", "_ro_v"
    d = (df.withColumn(T, F.unix_micros(F.col(ts_col)))
           .withColumn(B, F.floor(F.col(T) / F.lit(bucket_us)))
           .withColumn(V, _observed(value_col)))
    order = [F.col(T)] + [F.col(c) for c in tiebreak]
    v = F.col(V)

    w_in = Window.partitionBy(*keys, B).orderBy(*order)
    w_frame = w_in.rowsBetween(-n_rows, -1)
    rows = d.select("*", F.row_number().over(w_in).alias("_pos"),
                    *[c.alias(f"_in_{s}") for c, s in zip(_stats(v, w_frame), STAT_NAMES)])

    # Last n_rows rows of every bucket (sorted once per bucket), then the last n_rows
    # rows before each bucket: the sorted tails of up to n_rows preceding non-empty
    # buckets, flattened in bucket order (so already in time order) and trimmed.
    w_last = Window.partitionBy(*keys, B).orderBy(*[o.desc() for o in order])
    item = F.struct(F.col(T).alias("t"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(tiebreak)],
                    v.alias("v"))
    tails = (d.select(*keys, B, item.alias("_item"), F.row_number().over(w_last).alias("_rd"))
              .filter(F.col("_rd") <= n_rows)
              .groupBy(*keys, B).agg(F.array_sort(F.collect_list("_item")).alias("_tail")))
    w_prev = Window.partitionBy(*keys).orderBy(F.col(B)).rowsBetween(-n_rows, -1)
    prev = F.transform(F.flatten(F.collect_list("_tail").over(w_prev)), lambda x: x["v"])
    k = F.size(F.col("_prev_vals"))
    last = F.slice(F.col("_prev_vals"), F.greatest(k - n_rows + 1, F.lit(1)), F.lit(n_rows))

    # suffix[j] = stats of the last j context values, j = 0..n_rows (computed per bucket, not per row)
    kk = F.size(F.col("_ctx"))

    def values(j: Column) -> Column:
        own = F.filter(F.slice(F.col("_ctx"), F.greatest(kk - j + 1, F.lit(1)), F.least(j, kk)),
                       lambda x: x.isNotNull())
        return F.struct(own.alias("own"), F.size(own).cast("long").alias("n"), F.aggregate(
            own, F.lit(0).cast(DEC), lambda a, x: _dec(a + _dec(x))).alias("dsum"))

    def stats(s: Column) -> Column:
        mean = mean_of(s["n"], s["dsum"])
        return F.struct(s["n"].alias("n"), s["dsum"].alias("dsum"), F.aggregate(
            s["own"], F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)).alias("m2"),
            F.array_min(s["own"]).alias("min"), F.array_max(s["own"]).alias("max"))

    suffix = F.transform(F.transform(F.sequence(F.lit(0), F.lit(n_rows)), values), stats)
    ctx = (tails.select(*keys, B, F.coalesce(prev, F.array().cast("array<double>")).alias("_prev_vals"))
                .select(*keys, B, last.alias("_ctx"))
                .select(*keys, B, suffix.alias("_suffix")))

    out = rows.join(ctx.hint("merge"), on=keys + [B], how="left")
    need = F.lit(n_rows) - F.least(F.col("_pos") - 1, F.lit(n_rows))
    out = out.withColumn("_part", F.element_at(F.col("_suffix"), (need + 1).cast("int")))
    out = out.select("*", *[F.col("_part")[s].alias(f"_ctx_{s}") for s in STAT_NAMES])
    return out.select(*df.columns, *combined(["_in_", "_ctx_"], prefix))


def mean_std(prefix: str) -> tuple[Column, Column]:
    """Mean (n >= 1) and sample standard deviation (n >= 2) from ``{prefix}n, dsum, m2, min, max``.

    The mean is the exact sum as a double divided by n. Equal values have no spread,
    whatever the rounding of their mean.
    """
    n, dsum, m2, low, high = (F.col(f"{prefix}{s}") for s in STAT_NAMES)
    mean = F.when(n > 0, mean_of(n, dsum))
    return mean, F.when(n > 1, F.when(low == high, F.lit(0.0)).otherwise(F.sqrt(m2 / (n - 1))))
