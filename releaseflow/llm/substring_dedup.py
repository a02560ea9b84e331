"""Removal of repeated passages (operator 5): fixed-block anchors.

Every document's non-overlapping blocks of ``ANCHOR`` words are the index; every
rolling window of that size probes it. A passage of ``WINDOW`` words that occurs
elsewhere holds a whole block of its other occurrence, so all repeats lie around
hits. Hits are extended to maximal exact repeats: every ``WINDOW``-word window
over a hit is compared by its 64-bit hash, the first occurrence (smallest id, then
earliest start) stays, and words covered by later occurrences go.

Texts move once, to chunks of consecutive ids; what chunks exchange are packed
hash lists, in which a chunk names each hash once however often it occurs, so hot
passages and groups of copies weigh no more than others.

A null or empty text has no words. Null ids come before all others. Rows that
repeat an id are ordered by text; of identical rows one counts as first. Each
input row gives one result row. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from releaseflow.llm.ship import ship
from releaseflow.llm.windows import (CELL_SCHEMA, Cells, Words, bucket_count, chunked, in_order,
                                     shared_cells, texts_of)

WINDOW, ANCHOR = 20, 10


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchor-size hashes, their positions' index, counts, and which are index blocks."""
    fits = words.fits(ANCHOR)
    at = np.flatnonzero(fits)
    uniq, inv, count = np.unique(words.windows(ANCHOR)[at], return_inverse=True, return_counts=True)
    block = np.zeros(len(uniq), bool)
    block[inv[words.offset()[at] % ANCHOR == 0]] = True
    back = np.full(len(fits), -1, np.int64)
    back[at] = inv
    return uniq, back, count, block


def _probe(buckets: int):
    def run(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        uniq, _, count, block = _anchors(Words.of(texts_of(docs)))
        return Cells(uniq, buckets).rows(key[0], count > 1, block)

    return run


def _around_hits(buckets: int):
    def run(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"bucket": pd.Series(dtype="int32"), "chunk": pd.Series(dtype="int64"),
                             "hashes": pd.Series(dtype=object)})
        if not len(answers) or not len(docs):
            return none
        words = Words.of(texts_of(docs))
        uniq, back, _, _ = _anchors(words)
        hit = np.append(Cells(uniq, buckets).answers(answers), False)[back]
        seen = np.concatenate([[0], np.cumsum(hit)])
        n = len(hit)
        near = seen[np.minimum(np.arange(n) + ANCHOR, n)] > seen[:-1]
        found = np.unique(words.windows(WINDOW)[near & words.fits(WINDOW)])
        if not len(found):
            return none
        order = np.argsort(found % np.uint64(buckets), kind="stable")
        found = found[order]
        edges = np.searchsorted((found % np.uint64(buckets)).astype(np.int64), np.arange(buckets + 1))
        rows = [(b, key[0], found[lo:hi].tobytes())
                for b, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi]
        return pd.DataFrame(rows, columns=none.columns)

    return run


def _met_before(rows: pd.DataFrame) -> pd.DataFrame:
    """Per chunk, the hashes that a chunk before it has too."""
    rows = rows.sort_values("chunk", ignore_index=True)
    lists = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
    chunks = rows["chunk"].to_numpy()
    hashes = np.concatenate(lists)
    source = np.repeat(np.arange(len(lists)), list(map(len, lists)))
    _, first, inv = np.unique(hashes, return_index=True, return_inverse=True)
    later = chunks[source] > chunks[source[first]][inv]
    out = [(c, h[m].tobytes()) for c, h, m in
           zip(chunks, lists, np.split(later, np.cumsum(list(map(len, lists)))[:-1])) if m.any()]
    return pd.DataFrame(out, columns=["chunk", "hashes"])


def _kept(docs: pd.DataFrame, before: list[bytes]) -> list[tuple[int, int, str]]:
    """``(words, words removed, words kept)`` of a chunk's documents, which are in order."""
    words = Words.of(texts_of(docs))
    hashes, at = words.windows(WINDOW), np.flatnonzero(words.fits(WINDOW))
    _, first, inv = np.unique(hashes[at], return_index=True, return_inverse=True)
    repeat = first[inv] != np.arange(len(at))
    if before:
        repeat |= np.isin(hashes[at], np.frombuffer(b"".join(before), np.uint64))
    starts = np.zeros(len(hashes) + 1, np.int64)
    starts[at[repeat] + 1] = 1
    starts = np.cumsum(starts)
    here = np.arange(len(hashes))
    gone = starts[here + 1] > starts[np.maximum(here - WINDOW + 1, 0)]
    out = []
    for lo, hi in zip(words.start, words.start[1:]):
        drop = gone[lo:hi]
        kept = words.words[lo:hi]
        if drop.any():
            kept = [w for w, d in zip(kept, drop.tolist()) if not d]
        out.append((hi - lo, int(drop.sum()), b" ".join(kept).decode("utf-8", "surrogatepass")))
    return out


def _strip(key: tuple, docs: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
    docs = in_order(docs)
    kept = _kept(docs, list(before["hashes"]))
    out = pd.DataFrame([(i, *k) for i, k in zip(docs["id"], kept)], columns=["id", "n_words", "n_removed", "kept_text"])
    return out.astype({"id": "Int64"})


def _cut(row_type: pa.DataType):
    """Every row as it came, with its text without the repeats; a text without any stays as it is."""

    def run(docs: pa.Table, before: pa.Table) -> pa.Table:
        frame = docs.select(["id", "text"]).to_pandas()
        frame["at"] = np.arange(len(frame))
        frame = in_order(frame)
        texts = [kept if removed else text for text, (_, removed, kept) in
                 zip(texts_of(frame), _kept(frame, before.column("hashes").to_pylist()))]
        rows = docs.column("row").take(pa.array(frame["at"])).cast(row_type)
        return pa.table({"row": rows, "cut": pa.array(texts, pa.string())})

    return run


def _met_passages(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The chunks' documents, and per chunk the window hashes that a chunk before it has too."""
    ship(df.sparkSession)
    # A word and the blank after it take two bytes at least, mostly some six.
    buckets = bucket_count(df, df.agg(F.sum(F.floor(F.octet_length(text_col) / F.lit(6)))).first()[0])
    docs = chunked(df, id_col, text_col)
    per_chunk = docs.groupBy("chunk")
    answers = shared_cells(per_chunk.applyInPandas(_probe(buckets), CELL_SCHEMA))
    repeats = per_chunk.cogroup(answers.groupBy("chunk")).applyInPandas(
        _around_hits(buckets), "bucket int, chunk long, hashes binary")
    return docs, repeats.groupBy("bucket").applyInPandas(_met_before, "chunk long, hashes binary")


def strip_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept_text)``; kept words joined by one blank."""
    docs, before = _met_passages(df, id_col, text_col)
    out = docs.groupBy("chunk").cogroup(before.groupBy("chunk")).applyInPandas(
        _strip, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col).select(F.col(id_col), "n_words", "n_removed", "kept_text")


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the repeats cut out of its texts; texts without any stay as they are.

    Rows travel whole beside their texts, so ids may be null or shared.
    """
    _, before = _met_passages(df, id_col, text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns if c != text_col)).alias("row")
    docs = chunked(df, id_col, text_col, row)
    out = docs.groupBy("chunk").cogroup(before.groupBy("chunk")).applyInArrow(
        _cut(to_arrow_type(docs.schema["row"].dataType)),
        StructType([StructField("row", docs.schema["row"].dataType), StructField("cut", StringType())]))
    return out.select(*((F.col("cut") if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns))
