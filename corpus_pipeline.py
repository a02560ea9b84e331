"""Corpus preparation as five stages over ``documents``.

language ID -> n-gram Jaccard join -> substring dedup -> secret scans -> packing.
Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept and
returns the columns of documents (the last one: packed pieces). ``run`` writes each
stage's result as Parquet in the shared folder and reads it again.

Null texts: rejected by the first stage as having no language. Extra columns pass
through, also under names that the operators use for their results; repeated rows
are copies, of which one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from releaseflow.llm import jaccard_join, langid, packing, secret_ledger, substring_dedup
from releaseflow.llm.components import saved
from releaseflow.session import scratch_path

#: SQL cannot express the language model or the packing; tests hold run() against brute force.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model is sure enough of."""
    model = langid.fit_languages(docs)
    places = [f"in_{k}" for k in range(len(docs.columns))]  # the caller's names meet none of the operator's
    judged = langid.predict_languages(docs.toDF(*places), model, places[docs.columns.index("text")])
    return judged.filter(~F.col("rejected")).select(places).toDF(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id (null last) of each component of near duplicates.

    Rows are joined by a surrogate of id and text, so texts that share an id, or have
    none, are documents of their own; rows equal in both are copies.
    """
    sid = F.xxhash64("doc_id", "text").alias("sid")
    rows = docs.select(sid, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    comp = jaccard_join.jaccard_components(docs.select(sid, "text"), "sid")
    comp = saved(comp.select("sid", "component_id").distinct())
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "sid")
    # Only documents that are linked need their ids compared.
    linked = comp.filter("sid <> component_id").select("component_id").distinct()
    members = comp.join(linked, "component_id")
    ids = rows.select("sid", "row.doc_id").join(members, "sid")
    first = ids.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.sid").alias("sid"))
    gone = members.select("sid").join(first, "sid", "left_anti")
    return rows.join(gone, "sid", "left_anti").dropDuplicates(["sid"]).select("row.*")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of passages that occur earlier; texts without any stay as they are."""
    out = substring_dedup.cut_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by ``secret_ledger.MASK``."""
    out = secret_ledger.mask_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training windows of 1024 ids, one row per piece; ``token_bytes`` holds the ids (little-endian 32 bit)."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                    public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("token_bytes").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "token_bytes")


STAGES = [
    ("language_id", keep_known_language),
    ("jaccard_join", keep_one_of_each),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table: the pieces' places and checksums.

    The ids themselves (``token_bytes``) stay in the last stage's table in the shared folder.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "corpus", unique=True)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs.drop("token_bytes")
