"""Registered queries of the operators and their DuckDB twins.

A query applies its operator to the whole table and derives the digest columns
of the result from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.llm import (bpe, embedding_dedup, html_extract, jaccard_join, langid, lexical_search, packing,
                              periodic_runs, pii, secret_ledger, spans, substring_dedup, topk, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(_table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN, decode=True)
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_register
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_components(_table(spark, sf_dir, "embeddings"))


ORACLES["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
comp AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e LEFT JOIN n USING (vec_id) LEFT JOIN comp USING (vec_id)
"""


@_register
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT c.a, c.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY ALL) c JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b
  WHERE 100 * c.o >= 75 * (na.n + nb.n - c.o)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


@_register
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


@_register
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.strip_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op5_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(list_slice(w, i, i + 19), ' ')
                                       ORDER BY doc_id, i) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20)),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM starts, range(20) r(j) WHERE k > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, count(g.i) AS n_removed,
         string_agg(CASE WHEN g.i IS NULL THEN word END, ' ' ORDER BY words.i) AS t
  FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@_register
def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op6_top_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""


@_register
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@_register
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs)
    held_out = F.coalesce(~langid.learnable(), F.lit(False))
    return langid.predict_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def _span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select("doc_id", *(spans.count_of(F.col("base"), k).alias(f"n_{k}") for k in kinds),
                        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"),
                        spans.joined(F.col("spans")).alias("spans"))


@_register
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(pii.personal_data(_table(spark, sf_dir, "documents")), pii.KINDS[:4])


@_register
def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(secret_ledger.scan_secrets(_table(spark, sf_dir, "documents")), secret_ledger.BASE)


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text, in which documents chosen by their id's checksum repeat a stretch of their words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size("words"), F.floor(h / 10)
    at = F.pmod(g, n)
    period = F.floor((n - at) / (F.lit(3) + g % 8)) + 1
    places = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
                         lambda i: F.when(i < at, i).otherwise(at + F.pmod(i - at, period)))
    moved = F.array_join(F.transform(places, lambda i: F.get("words", i.cast("int"))), " ")
    words = F.when(F.coalesce(h % 10 == 0, F.lit(False)), words).otherwise(F.array().cast("array<string>"))
    return docs.select("doc_id", "text", F.coalesce(words, F.array().cast("array<string>")).alias("words")).select(
        "doc_id", F.when(n > 0, moved).otherwise(F.col("text")).alias("text"))


@_register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.collapse_runs(_with_planted_periods(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("strongest")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLES["op11_periodic_runs"] = r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
           string_split(CAST(doc_id AS VARCHAR), ''),
           lambda c: list_concat([CAST(ascii(c) AS BIGINT)], list_resize(CAST([] AS BIGINT[]), 8, 256))))),
           lambda a, b: CASE WHEN b < 256 THEN xor(a, b)
                             WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) AS h
  FROM documents),
place AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a,
         CASE WHEN len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) ELSE 1 END AS p
  FROM raw),
d AS (
  SELECT r, doc_id, CAST(n AS BIGINT) AS n, CASE WHEN a >= n THEN w ELSE list_transform(range(n),
    lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM place),
grams AS (
  SELECT r, n, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS g
  FROM (SELECT r, n, w, unnest(range(n - 4)) AS i FROM d WHERE n >= 6)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y
    ON x.r = y.r AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isles AS (
  SELECT r, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs)
  GROUP BY r, q, k),
runs AS (
  SELECT r, start, length, min(q) AS period FROM isles WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t
  FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM d WHERE r IN (SELECT r FROM runs))
  ANTI JOIN gone USING (r, i) GROUP BY r),
sums AS (
  SELECT r, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s
  FROM runs GROUP BY r),
best AS (
  SELECT r, start, length, period FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE y.r = x.r AND (y.length * x.period > x.length * y.period
      OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period)))))
SELECT d.doc_id, coalesce(s.n_runs, 0) AS n_runs, b.start, b.length, b.period,
       1000 * b.length // b.period AS exponent_milli, sha256(coalesce(s.s, '')) AS runs_sha256,
       sha256(CASE WHEN s.r IS NULL THEN array_to_string(d.w, ' ') ELSE coalesce(k.t, '') END) AS collapsed_sha256
FROM d LEFT JOIN sums s USING (r) LEFT JOIN best b USING (r) LEFT JOIN kept k USING (r)
"""


@_register
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
c AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
m AS (SELECT r, doc_id, 75 + (25 * len(t) * c.n) // c.l AS m FROM d, c WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * c.n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
i AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
s AS (
  SELECT i.item_id, m.r, m.doc_id,
         CAST(sum(i.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY ALL)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0)
WHERE k <= 20
"""


@_register
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~toxicity.learnable(), F.lit(False))
    return toxicity.score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")
