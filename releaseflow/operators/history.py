"""History-aware operators.

All of them run as Spark jobs over the whole input; windows keyed by a
release or indicator name either go through the bucketed operators in
``rolling``/``sequence`` (event rows partitioned by key and hour, so a hot
key is spread over its hours) or run over per-(key, day) aggregates whose
size is bounded by the number of days, not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from releaseflow.functions.enrich import period_start
from releaseflow.operators.rolling import DAY_US, HOUR_US, mean_std, rolling_range_stats, rolling_rows_stats
from releaseflow.operators.sequence import asof_last, bucketed_row_number

YEAR_US = 365 * DAY_US
ZSCORE_THRESHOLD = 2.0


def _r(c: Column, d: int) -> Column:
    """Round half-up and fold -0.0 into 0.0."""
    return F.round(c, d) + F.lit(0.0)


def hist_context(enriched: DataFrame, window_us: int = YEAR_US, bucket_us: int = HOUR_US,
                 key: str = "indicator", id_cols: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Value against the same indicator's history in (ts - window, ts]: count, mean, min, max."""
    st = rolling_range_stats(enriched, [key], "kafka_ts", "value", list(id_cols), window_us, bucket_us)
    mean, _ = mean_std("hist_")
    return st.select("*", mean.alias("hist_mean")).drop("hist_sum", "hist_dsum", "hist_m2")


def zscore_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """hist_mean, hist_std, zscore, is_zscore_anomaly from the statistics {prefix}n, dsum, m2, min, max,
    which are dropped unless named in ``keep``."""
    mean, sd = mean_std(prefix)
    z = F.when((F.col(f"{prefix}n") >= 2) & (sd > 0), (F.col("value") - mean) / sd)
    drop = [f"{prefix}{s}" for s in ("sum", "dsum", "m2", "min", "max") if s not in keep]
    return df.select("*", mean.alias("hist_mean"), _r(sd, 6).alias("hist_std"),
                     _r(z, 4).alias("zscore"),
                     F.coalesce(F.abs(z) > ZSCORE_THRESHOLD, F.lit(False)).alias("is_zscore_anomaly")
                     ).drop(*drop)


def rolling_zscore(enriched: DataFrame, window_us: int = YEAR_US, bucket_us: int = HOUR_US,
                   key: str = "indicator", id_cols: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """z-score of value against the indicator's values in the preceding window
    (needs >= 2 prior values and a non-zero spread; current row excluded)."""
    st = rolling_range_stats(enriched, [key], "kafka_ts", "value", list(id_cols), window_us, bucket_us)
    return zscore_columns(st, "hist_")


def rolling_zscore_obs(enriched: DataFrame, n_obs: int = 12, bucket_us: int = HOUR_US,
                       key: str = "indicator", tiebreak: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """z-score against the previous ``n_obs`` observations of the indicator."""
    st = rolling_rows_stats(enriched, [key], "kafka_ts", list(tiebreak), "value", n_obs, bucket_us,
                            prefix="hist_")
    return zscore_columns(st, "hist_")


def first_observations(releases: DataFrame) -> DataFrame:
    """One observation per (release_name, period): the first non-missing value.

    ``min_by`` is a hash/sort aggregate with map-side combine, so a hot
    (release, period) is reduced before the shuffle."""
    order = F.struct(F.col("kafka_ts"), F.col("seq"))
    return (releases.filter(F.col("value").isNotNull())
            .groupBy("release_name", "period")
            .agg(F.min_by(F.struct("value", "event_id"), order).alias("_first"))
            .select("release_name", "period", F.col("_first.value").alias("value"),
                    F.col("_first.event_id").alias("event_id")))


def prior_from_lag(observations: DataFrame) -> DataFrame:
    """prior_value = the series' previous observation (by period). The window runs
    over one row per (series, period), bounded by the number of periods."""
    w = Window.partitionBy("release_name").orderBy(period_start(F.col("period")), "period")
    return observations.withColumn("prior_value", F.lag("value").over(w))


def new_observations(observations: DataFrame, known_keys: DataFrame) -> DataFrame:
    """Observations whose (release_name, period) has not been published yet."""
    return observations.join(known_keys.select("release_name", "period").distinct(),
                             on=["release_name", "period"], how="left_anti")


def numbered_vintages(releases: DataFrame) -> DataFrame:
    """Every published value of a (release_name, period) with its vintage, 1 for the first.

    Values at the same time are one vintage: the last by seq."""
    same = releases.filter(F.col("value").isNotNull()).groupBy("release_name", "period", "kafka_ts").agg(
        F.max_by(F.struct("value", "event_id", "seq"), "seq").alias("_v"))
    rows = same.select("release_name", "period", "kafka_ts", "_v.*")
    return bucketed_row_number(rows, ["release_name", "period"], "kafka_ts", ["seq"], "vintage")


def prior_as_known(releases: DataFrame) -> DataFrame:
    """Each event with the prior period's value as it was known when the event came: no later revision.

    The prior period is the release's previous one by the calendar. ``prior_known`` and its
    ``prior_vintage`` and ``prior_event_id`` are null if nothing had been published for it by then.
    """
    w = Window.partitionBy("release_name").orderBy(period_start(F.col("period")), "period")
    periods = (releases.filter(F.col("period").isNotNull()).select("release_name", "period").distinct()
               .withColumn("prior_period", F.lag("period").over(w)))
    events = releases.join(periods, ["release_name", "period"], "left").select(
        "event_id", "release_name", "period", "kafka_ts", "value", "prior_period")
    facts = numbered_vintages(releases).select(
        "release_name", F.col("period").alias("prior_period"), "kafka_ts", "seq", F.col("value").alias("prior_known"),
        F.col("vintage").alias("prior_vintage"), F.col("event_id").alias("prior_event_id"))
    return asof_last(events, facts, ["release_name", "prior_period"], "kafka_ts", ["seq"],
                     ["prior_known", "prior_vintage", "prior_event_id"])


def revision_vintages(releases: DataFrame) -> DataFrame:
    """Per (indicator, period): how many vintages, the first and the latest value
    (ordered by release time, original before revision, event_id) and the total revision."""
    order = F.struct(F.try_to_timestamp(F.col("release_ts")), F.coalesce("revision", F.lit(False)),
                     F.col("event_id"))
    return (releases.groupBy("indicator", "period")
            .agg(F.count(F.lit(1)).alias("n_vintages"),
                 F.min_by(F.struct("value", "release_name"), order).alias("_first"),
                 F.max_by(F.struct("value", "release_name"), order).alias("_last"))
            .select("indicator", "period", "n_vintages",
                    F.col("_first.value").alias("first_value"),
                    F.col("_last.value").alias("latest_value"),
                    F.col("_first.release_name").alias("first_release"),
                    F.col("_last.release_name").alias("latest_release"),
                    _r(F.col("_last.value") - F.col("_first.value"), 6).alias("revision_delta")))


def release_days(releases: DataFrame) -> DataFrame:
    """Events of each release on each day."""
    return (releases.groupBy("release_name", F.to_date("kafka_ts").alias("release_date"))
            .agg(F.count(F.lit(1)).alias("n_events")))


def match_schedule(days: DataFrame, calendar: DataFrame, tolerance_days: int, date_col: str = "release_date",
                   key: str = "release_name") -> DataFrame:
    """Add ``matched_date``, ``days_off`` and ``expected_value`` of the nearest scheduled date within ``tolerance_days``.

    A range join by buckets: a scheduled date is put into each bucket of ``tolerance_days + 1`` days that it can
    match into (two or three), a row looks into its own. ``days_off`` is negative before the scheduled date; of two
    dates equally near the earlier counts. Rows without a date in reach, or with nulls, keep nulls.
    """
    width = tolerance_days + 1
    day = F.unix_date(date_col)
    slots = F.sequence(F.floor((F.col("_at") - tolerance_days) / width), F.floor((F.col("_at") + tolerance_days) / width))
    planned = (calendar.select(F.col(key), F.to_date("release_date").alias("matched_date"), "expected_value")
               .filter(F.col(key).isNotNull() & F.col("matched_date").isNotNull())
               .withColumn("_at", F.unix_date("matched_date")).withColumn("_slot", F.explode(slots)))
    own = days.withColumn("_slot", F.floor(day / width))
    off = F.datediff(F.col(date_col), F.col("matched_date"))
    best = (own.select(key, date_col, "_slot").distinct().join(planned, [key, "_slot"])
            .withColumn("days_off", off).filter(F.abs("days_off") <= tolerance_days)
            .groupBy(key, date_col).agg(F.min_by(F.struct("matched_date", "days_off", "expected_value"),
                                                 F.struct(F.abs("days_off"), "matched_date")).alias("_m")))
    return days.join(best, [key, date_col], "left").select(*days.columns, "_m.*")


def calendar_events(releases: DataFrame, calendar: DataFrame, catalog: DataFrame) -> DataFrame:
    """Release schedule seen in the data, joined to the fixed calendar and catalog.

    One row per (release_name, release date) with the month period, the number
    of events, the gap in days to the release's previous date, and the
    calendar's expected value when the date was scheduled. The per-day
    aggregate comes first, so the window runs over dates, not events.
    """
    days = release_days(releases)
    w = Window.partitionBy("release_name").orderBy("release_date")
    days = days.withColumn("gap_days", F.datediff("release_date", F.lag("release_date").over(w)).cast("long"))
    cal = calendar.select("release_name", F.to_date("release_date").alias("release_date"),
                          "expected_value", F.lit(True).alias("scheduled"))
    cat = catalog.select("release_name", "source", "indicator", "frequency")
    return (days.join(F.broadcast(cal), on=["release_name", "release_date"], how="left")
                .join(F.broadcast(cat), on="release_name", how="left")
                .select("release_name", "release_date",
                        F.date_format("release_date", "yyyy-MM").alias("period"),
                        "source", "indicator", "frequency", "n_events", "gap_days", "expected_value",
                        F.coalesce(F.col("scheduled"), F.lit(False)).alias("scheduled")))
