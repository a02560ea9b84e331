"""Secrets in a corpus by an incremental blob ledger (operator 10), native.

Every text is addressed by its SHA-256. The ledger holds, per blob and rule
version, what was found. A scan looks only at blobs that the ledger has not under
this version, one text per blob, then joins findings back to all rows that
hold the blob. Copies, however many, are read by the rules once.

A null text counts as empty. Repeated rows each give a result. Other columns are
ignored by ``scan_secrets`` and kept by ``mask_secrets``; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.llm.components import saved
from releaseflow.llm.spans import SPAN, chunks, find, masked, pieces, searchable
from releaseflow.session import path_exists

RULE_VERSION = 2
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "private_key", "web_token", "service_token")
MASK = "[SECRET]"

_NAME = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
_GAP, _EOL, _BASE64 = r"(?:\s|\\[nrt])", r"(?:\r?\n|(?:\\r)?\\n)", "[A-Za-z0-9+/]"
_KEY = r"[A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_KEY_END = f"-----END {_KEY}"
#: What follows the first line of a key: all up to its last line if that is a key's body, or else the run of base64 lines.
_KEY_BODY = (
    rf"(?:(?:[A-Za-z0-9+/=\s]++|\\[nrt])*+{_KEY_END}"
    rf"|(?=(?:(?!-----)[\s\S]){{0,400}}?{_BASE64}{{16}})[^-]*+(?:-(?!----)[^-]*+)*+{_KEY_END}"
    rf"|(?:{_GAP}*+[A-Z][A-Za-z-]{{2,40}}:\x20[^\n\\]*+)*+"
    rf"(?:{_GAP}*+{_BASE64}{{16,}}+={{0,2}}|{_EOL}[\x20\t]*+{_BASE64}++={{0,2}}(?=[\x20\t]*+(?:{_EOL}|\z)))++)?+")
_PATTERNS = {
    "assign": _NAME + r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "private_key": f"-----BEGIN {_KEY}{_KEY_BODY}",
    "web_token": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{12,}+\.eyJ[A-Za-z0-9_-]{12,}+\.[A-Za-z0-9_-]{16,}+",
    "service_token": r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{24,}+)",
}


def _valid(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_replace(match, f"^{_NAME}", "")) >= 6
    return F.length(match) >= 20


def _checked(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: _valid(kind, s["text"]))


def blob_of(text: Column) -> Column:
    """Content address of a text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], f"blob string, rules int, spans array<{SPAN}>")


def scan_unseen(df: DataFrame, ledger: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """New ledger rows ``(blob, rules, spans)`` for blobs not yet scanned by these rules."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key")
    rows = df.select(key, F.col(text_col).alias("text")).withColumn("blob", blob_of(F.col("text")))
    done = ledger.filter(F.col("rules") == RULE_VERSION).select("blob")
    todo = rows.groupBy("blob").agg(F.min("key").alias("key")).join(done, "blob", "left_anti")
    # Rows that repeat id and text are scanned alike and folded below.
    texts = rows.join(todo, ["key", "blob"], "left_semi").select("blob", searchable(F.col("text")).alias("clean"))
    texts = texts.select("blob", *(pieces(F.col("clean"), p).alias(f"p_{k}") for k, p in _PATTERNS.items()))
    spans = F.sort_array(F.concat(*(
        _checked(find(F.col(f"p_{k}"), k, n), k) for n, k in enumerate(KINDS))))
    return (texts.select("blob", F.lit(RULE_VERSION).alias("rules"), spans.alias("spans"))
            .groupBy("blob", "rules").agg(F.max("spans").alias("spans")))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger; where nothing is stored, an empty one. A blob that two scans stored counts once."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"blob string, rules int, spans array<{SPAN}>")
    stored = spark.read.schema(f"blob string, spans array<{SPAN}>, rules int").parquet(path)
    return stored.groupBy("blob", "rules").agg(F.max("spans").alias("spans"))


def update_ledger(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Scan what the ledger at ``path`` has not seen under these rules, add it, and return how many blobs that were.

    New rows appear at once when the write commits; a scan that dies before adds nothing. Rows of earlier
    rules stay, so a rule bump scans every blob again and an older version's findings can still be read.
    """
    new = saved(scan_unseen(df, read_ledger(df.sparkSession, path), id_col, text_col))
    n = new.count()
    if n:
        new.write.mode("append").partitionBy("rules").parquet(path)
    return n


def _findings(df: DataFrame, ledger: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    old = empty_ledger(df) if ledger is None else ledger
    new = saved(scan_unseen(df, old, id_col, text_col))
    known = old.filter(F.col("rules") == RULE_VERSION).unionByName(new)
    return known.filter(F.size("spans") > 0).select("blob", "spans")


def _joined_back(rows: DataFrame, findings: DataFrame) -> DataFrame:
    none = F.array().cast(f"array<{SPAN}>")
    return rows.join(findings, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def scan_secrets(df: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, base, spans)``, one row per input row; spans sorted by start, then kind as listed."""
    rows = df.select(F.col(id_col), blob_of(F.col(text_col)).alias("blob"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return _joined_back(rows, _findings(df, ledger, id_col, text_col)).select(
        id_col, base.alias("base"), "spans")


def mask_secrets(df: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``df`` with every secret in the text replaced by ``MASK``."""
    findings = _findings(df, ledger, id_col, text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")  # the caller's names meet none of ours
    out = _joined_back(df.select(row, blob_of(F.col(text_col)).alias("blob")), findings)
    text = F.col(f"row.`{text_col}`")
    out = out.select("row", "spans", F.inline(F.array(F.struct(F.when(F.size("spans") > 0, chunks(text)).alias("parts")))))
    text = F.when(F.size("spans") > 0, masked(F.col("parts"), F.length(text), F.col("spans"), MASK)).otherwise(text)
    return out.select(*((text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns))
