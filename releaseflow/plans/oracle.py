"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code: the same adapter rules and report
definitions, expressed as plain SQL over the pre-registered parquet views.
Timestamps and dates are rendered as text on both sides.
"""

from __future__ import annotations

from releaseflow.schema import HIGH_IMPACT_RELEASES, RELEASE_CATALOG

TS_FMT = "'%Y-%m-%d %H:%M:%S.%f'"
ISO_FMT = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def ts(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, {TS_FMT}) AS {alias or col}"


def dt(col: str, alias: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {alias or col}"


_CATALOG_VALUES = ", ".join(
    f"({i}, '{r[0]}', '{r[1]}', '{r[2]}', '{r[3]}')" for i, r in enumerate(RELEASE_CATALOG))
_HIGH = ", ".join(f"'{n}'" for n in HIGH_IMPACT_RELEASES)

# Adapter events -> release events -> enriched rows (processed_ts = kafka_ts).
BASE_CTES = f"""
cat AS (
  SELECT * FROM (VALUES {_CATALOG_VALUES}) t(idx, release_name, indicator, source, frequency)
),
ev AS (
  SELECT event_id AS seq,
         CAST(event_id AS VARCHAR) AS event_id,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(((user_id % 13) + 13) % 13 AS INTEGER) AS idx,
         CAST(ts AS TIMESTAMP) AS kafka_ts,
         event_type,
         CASE WHEN event_id % 50 = 0 THEN NULL
              WHEN event_id % 11 = 0 THEN -value
              ELSE value END AS value
  FROM events
),
rel AS (
  SELECT ev.seq, ev.event_id, cat.source, cat.release_name, cat.indicator,
         strftime(ev.kafka_ts, '%Y-%m-%d') AS period,
         ev.value,
         CASE WHEN ev.k % 5 = 0 THEN NULL
              WHEN ev.k % 5 = 1 THEN ev.value
              ELSE lag(ev.value) OVER (PARTITION BY cat.release_name ORDER BY ev.kafka_ts, ev.seq)
         END AS prior_value,
         CAST(NULL AS DOUBLE) AS surprise_pct_in,
         ev.event_type = 'error' AS revision,
         CASE WHEN ev.k = 0 THEN 0.0
              WHEN ev.k = 1 THEN NULL
              ELSE floor(ev.value * (200 + ev.k) / 250.0 * 100.0) / 100.0
         END::DOUBLE AS consensus,
         strftime(ev.kafka_ts, {ISO_FMT}) AS release_ts,
         strftime(ev.kafka_ts, {ISO_FMT}) AS ingested_ts,
         ev.kafka_ts,
         CAST(ev.seq % 3 AS INTEGER) AS "partition",
         ev.seq // 3 AS "offset"
  FROM ev JOIN cat ON ev.idx = cat.idx
),
s1 AS (
  SELECT *, CASE WHEN consensus IS NOT NULL AND consensus <> 0
                 THEN round((value - consensus) / abs(consensus) * 100, 4) END AS surprise_pct
  FROM rel
),
enr AS (
  SELECT *,
    CASE WHEN release_name IN ({_HIGH}) AND abs(surprise_pct) > 5 THEN 'HIGH'
         WHEN release_name IN ({_HIGH}) THEN 'MEDIUM'
         WHEN revision = true THEN 'LOW'
         ELSE 'MEDIUM' END AS market_impact,
    CASE WHEN prior_value IS NULL THEN 'UNKNOWN'
         WHEN value > prior_value * 1.001 THEN 'UP'
         WHEN value < prior_value * 0.999 THEN 'DOWN'
         ELSE 'FLAT' END AS value_direction,
    CASE WHEN abs(surprise_pct) > 10 THEN true
         WHEN value IS NULL THEN true
         ELSE false END AS is_anomaly,
    CASE WHEN abs(surprise_pct) > 10 THEN 'Large surprise: ' || CAST(surprise_pct AS VARCHAR) || '%'
         WHEN value IS NULL THEN 'Missing value' END AS anomaly_reason,
    kafka_ts AS processed_ts,
    CAST(kafka_ts AS DATE) AS processing_date,
    seq // 1000 AS batch_id
  FROM s1
)
"""


def with_base(select_sql: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES.strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{select_sql.strip()}"

# Bus rows: clean releases plus the adapter's faults and duplicate deliveries.
BUS_CTES = """
bus_src AS (
  SELECT seq, event_id, source,
         CASE WHEN seq % 109 = 0 THEN lower(release_name) ELSE release_name END AS release_name,
         indicator, period, value, prior_value, revision, consensus, release_ts, ingested_ts,
         kafka_ts, "partition", "offset",
         CASE WHEN seq % 101 = 0 THEN 'malformed' WHEN seq % 103 = 0 THEN 'missing' ELSE 'ok' END AS fault
  FROM rel
),
bus AS (
  SELECT * FROM bus_src
  UNION ALL
  SELECT seq, event_id, source, release_name, indicator, period, value, prior_value, revision,
         consensus, release_ts, ingested_ts, kafka_ts, "partition", "offset" + 1099511627776, fault
  FROM bus_src WHERE seq % 20 = 0
),
valid AS (
  SELECT * FROM bus WHERE fault = 'ok'
)
"""


def json_sql(fields: list[tuple[str, str]], keep_nulls: bool) -> str:
    """A JSON object text as Spark's ``to_json`` renders it.

    kinds: str (no escaping needed in these fixtures), num, bool, ts (ISO, microseconds, Z).
    """
    parts = []
    for name, kind in fields:
        if kind == "str":
            val = f"'\"' || {name} || '\"'"
        elif kind == "num":
            val = f"CAST({name} AS VARCHAR)"
        elif kind == "bool":
            val = f"CASE WHEN {name} THEN 'true' ELSE 'false' END"
        elif kind == "ts":
            val = f"'\"' || strftime({name}, {ISO_FMT}) || '\"'"
        else:
            raise ValueError(kind)
        if keep_nulls:
            parts.append(f"'\"{name}\":' || coalesce({val}, 'null')")
        else:
            parts.append(f"CASE WHEN {name} IS NOT NULL THEN '\"{name}\":' || {val} END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def calendar_values_sql() -> str:
    from releaseflow.schema import RELEASE_CALENDAR_2024
    rows = ", ".join(
        f"('{d}', '{n}', {'NULL' if v is None else v})" for d, n, v in RELEASE_CALENDAR_2024)
    return (f"calendar AS (SELECT CAST(d AS DATE) AS release_date, n AS release_name, "
            f"CAST(v AS DOUBLE) AS expected_value FROM (VALUES {rows}) t(d, n, v))")
