"""Near-duplicate documents by n-gram Jaccard similarity (operator 3): prefix-tree join.

1. Documents are turned into sets of 5-word shingles (64-bit hashes). Equal sets
   fold into one class, kept by its smallest id.
2. Chunks of documents learn which shingles of their classes another class has too
   (``windows.shared_cells``); a class needs that for three quarters of its set to
   be linked with anything, all others leave here.
3. Shingles get a global order, rarest first. Two linked classes share one of the
   first ``n - ceil(0.75 n) + 1`` shingles of each; classes joined by such shingles
   form candidate clusters.
4. In a cluster, sets ordered by frequency are stored in a compressed trie. Each
   set walks the trie once: overlaps with a shared prefix are counted once for all
   sets below it, and a subtree is left when even its remaining length cannot
   reach the needed overlap, or when all below it are linked with the set already.
5. Links are joined into components.

Clusters above ``BLOCK`` sets are cut into blocks. Each block is joined first,
together with the cluster's smallest set, which unites groups of near copies at
linear cost; pairs of blocks follow only for clusters that are then still in
several components. Pairs never leave a task: it sends one row per linked set.

A null or empty text has an empty set, linked with nothing; rows with a null id
have a null component. Repeated rows each give a result row. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releaseflow.llm.components import connected_components, saved
from releaseflow.llm.groups import runs
from releaseflow.llm.ship import ship
from releaseflow.llm.vocab import slices
from releaseflow.llm.windows import (CELL_SCHEMA, Cells, Words, mix, bucket_count, chunked,
                                     shared_cells, texts_of)

SHINGLE, PERCENT, BLOCK = 5, 75, 512


def _sets(docs: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(document number, shingle hash)`` pairs, by document, then hash."""
    words = Words.of(texts_of(docs), lower=True)
    at = np.flatnonzero(words.fits(SHINGLE))
    owner, hashes = words.document()[at], words.windows(SHINGLE)[at]
    sizes = np.diff(words.start)
    for doc in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):  # the whole sequence counts as one shingle
        whole = np.array([sizes[doc]], np.uint64)
        for h in words.hashes[words.start[doc]:words.start[doc + 1]]:
            whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + h)
        owner, hashes = np.append(owner, doc), np.append(hashes, whole)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


@dataclass
class _Chunk:
    """The sets of a chunk's documents: ``hashes[edges[k]:edges[k + 1]]`` for document k."""

    ids: list
    edges: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, docs: pd.DataFrame) -> _Chunk:
        owner, hashes = _sets(docs)
        return cls(docs["id"].tolist(), np.cumsum([0, *np.bincount(owner, minlength=len(docs))]), hashes)

    def signature(self, doc: int) -> tuple[int, int]:
        mine = self.hashes[self.edges[doc]:self.edges[doc + 1]]
        return tuple(int(mix(mine ^ np.uint64(k)).sum(dtype=np.uint64).astype(np.int64)) for k in (0, 0x5DEECE66D))

    def leads(self, told: pd.DataFrame) -> list[int]:
        """Documents that stand for their class; of rows that repeat an id, one."""
        left = set(zip(told["id"], told["s1"], told["s2"]))
        out = []
        for doc, name in enumerate(self.ids):
            key = (name, *self.signature(doc))
            if key in left:
                left.remove(key)
                out.append(doc)
        return out

    def members(self, docs: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of some documents, where each occurs among them, and how often."""
        parts = [self.hashes[self.edges[d]:self.edges[d + 1]] for d in docs]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return np.unique(flat, return_inverse=True, return_counts=True)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and signature of every document's set, where the scan left it."""
    for part, texts in slices(batches, "text"):
        chunk = _Chunk.of(pd.DataFrame({"id": part.column("id").to_pylist(), "text": texts}))
        marks = np.array([chunk.signature(k) for k in range(part.num_rows)], np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column("chunk"), part.column("id"), pa.array(np.diff(chunk.edges)), pa.array(marks[:, 0]),
             pa.array(marks[:, 1])], names=["chunk", "id", "n", "s1", "s2"])


def _offer(buckets: int):
    def run(key: tuple, docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk.of(docs)
        uniq, _, count = chunk.members(chunk.leads(told))
        return Cells(uniq, buckets).rows(key[0], count > 1, np.ones(len(uniq), bool))

    return run


def _survivors(buckets: int):
    """Classes whose sets are shared enough, with what they share."""

    def run(key: tuple, docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        chunk = _Chunk.of(docs)
        leads = chunk.leads(told[told["bits"].isna()])
        uniq, inv, _ = chunk.members(leads)
        shared = Cells(uniq, buckets).answers(told[told["bits"].notna()])[inv]
        out, at = [], 0
        for doc in leads:
            mine = chunk.hashes[chunk.edges[doc]:chunk.edges[doc + 1]]
            met = mine[shared[at:at + len(mine)]]
            at += len(mine)
            if 100 * len(met) >= PERCENT * len(mine):
                out.append((chunk.ids[doc], len(mine), met.astype(np.int64)))
        return pd.DataFrame(out, columns=["id", "n", "hashes"])

    return run


class _Trie:
    """Compressed trie over sets of whole numbers, each sorted ascending."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.order]
        lcp = [0, *(self._common(a, b) for a, b in zip(self.sets, self.sets[1:]))]
        lcp = np.array(lcp)
        length = np.array([len(s) for s in self.sets])
        ordered = sizes[self.order]
        # node: (segment, depth after it, lo, hi, longest remainder, smallest size, children)
        self.root = self._node(0, len(sets), 0, lcp, length, ordered)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        diff = np.flatnonzero(a[:n] != b[:n])
        return int(diff[0]) if len(diff) else n

    def _node(self, lo, hi, depth, lcp, length, sizes):
        root: list = []
        todo = [(lo, hi, depth, root)]
        while todo:
            lo, hi, depth, into = todo.pop()
            end = int(length[lo]) if hi - lo == 1 else int(lcp[lo + 1:hi].min())
            children: list = []
            into.append((self.sets[lo][depth:end], lo, hi, int(length[lo:hi].max()) - end,
                         int(sizes[lo:hi].min()), children))
            if hi - lo > 1:
                cuts = [lo, *(lo + 1 + np.flatnonzero(lcp[lo + 1:hi] == end)).tolist(), hi]
                todo += [(a, b, end, children) for a, b in zip(cuts, cuts[1:])]
        return root

    def overlaps(self, probe: np.ndarray, size: int, universe: int, wanted: np.ndarray) -> Iterator[tuple[int, int]]:
        """``(set, overlap)`` for wanted sets that share enough with the probe.

        Overlap o links sizes a and b when 100 o >= PERCENT (a + b - o).
        """
        member = np.zeros(universe, bool)
        member[probe] = True
        open_sets = np.cumsum([0, *wanted[self.order]])
        todo = [(node, 0) for node in self.root]
        while todo:
            (segment, lo, hi, rest, smallest, children), have = todo.pop()
            if open_sets[hi] == open_sets[lo]:
                continue
            have += int(np.count_nonzero(member[segment]))
            left = min(rest, len(probe) - have)
            if (100 + PERCENT) * (have + left) < PERCENT * (size + smallest):
                continue
            if children:
                todo += [(c, have) for c in children]
            else:
                yield self.order[lo], have


def _link_sets(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], label: np.ndarray,
               left: np.ndarray | None) -> np.ndarray:
    """Labels (smallest linked id) after joining all sets, or those of ``left`` with the others."""
    flat = np.concatenate(sets)
    uniq, inv, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(uniq), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(uniq))
    parts = [np.sort(p) for p in np.split(rank[inv], np.cumsum([len(s) for s in sets])[:-1])]
    trie = _Trie(parts, sizes)
    later = np.ones(len(ids), bool)
    for i in np.argsort(-sizes, kind="stable"):
        later[i] = False
        if left is not None and not left[i]:
            continue
        wanted = label != label[i]
        wanted &= ~left if left is not None else later
        if not wanted.any():
            continue
        for j, have in trie.overlaps(parts[i], int(sizes[i]), len(uniq), wanted):
            if label[j] != label[i] and 100 * have >= PERCENT * (sizes[i] + sizes[j] - have):
                label[(label == label[i]) | (label == label[j])] = min(label[i], label[j])
    return label


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for g in runs(batches, ["cluster", "bi", "bj"]):
        ids = g.column("id").to_numpy()
        if len(ids) < 2:
            continue
        label = g.column("label").to_numpy().copy()
        sets = [s.values.to_numpy() for s in g.column("hashes").combine_chunks()]
        left = None
        if g.column("bi")[0] != g.column("bj")[0]:
            left = g.column("blk").to_numpy() == g.column("bi")[0].as_py()
        root = _link_sets(ids, g.column("n").to_numpy(), sets, label, left)
        out.append((ids[root != ids], root[root != ids]))
        if len(out) >= 2000:
            yield _edges(out)
            out = []
    if out:
        yield _edges(out)


def _edges(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)],
                                      names=["id", "root"])


def _joined(rows: DataFrame) -> DataFrame:
    """Links found in rows of ``(cluster, bi, bj, blk, id, n, hashes, label)``."""
    return saved(rows.repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj")
                 .mapInArrow(_join_blocks, "id long, root long"))


def _candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ordered sets ``(id, n, hashes)`` that may be linked, and ``(id, cluster)``: those joined by
    a shingle of their prefixes."""
    grams = classes.select("id", "n", F.explode("hashes").alias("h"))
    freq = grams.groupBy("h").count().filter("count > 1")
    need = F.ceil(F.col("n") * PERCENT / F.lit(100)).cast("int")
    sets = saved(grams.join(freq, "h").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("count", "h"))).alias("grams"))
        .filter(F.size("grams") >= need)
        .select("id", "n", F.col("grams.h").alias("hashes")))
    prefix = sets.select("id", F.explode(F.slice("hashes", F.lit(1), F.size("hashes") - need + 1)).alias("h"))
    first = prefix.groupBy("h").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    cluster = connected_components(prefix.join(first, "h").select("id", "lead"), "id", "lead")
    return sets, cluster.withColumnRenamed("component", "cluster")


def _class_components(classes: DataFrame) -> DataFrame:
    """``(id, component)`` of linked classes."""
    sets, cluster = _candidates(classes)
    blocks = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    place = cluster.join(blocks, "cluster").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    everywhere = F.when(F.col("id") == F.col("cluster"), F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(
        F.array("blk"))
    links = _joined(sets.join(place.withColumn("bi", F.explode(everywhere)), "id")
                    .withColumn("bj", F.col("bi")).withColumn("label", F.col("id")))
    comp = connected_components(links, "id", "root")
    parted = (place.filter("nb > 1").join(comp, "id", "left")
              .withColumn("label", F.coalesce("component", "id")).drop("component"))
    open_clusters = parted.groupBy("cluster").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter(
        "a < b").select("cluster")
    if open_clusters.isEmpty():
        return comp
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    cross = (parted.join(open_clusters, "cluster").withColumn("o", other).filter("o != blk")
             .withColumn("bi", F.least("blk", "o")).withColumn("bj", F.greatest("blk", "o")).drop("o"))
    return connected_components(links.union(_joined(sets.join(cross, "id"))), "id", "root")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)``, one row per input row."""
    ship(df.sparkSession)
    rows = chunked(df, id_col, text_col)
    docs = saved(rows.mapInArrow(_describe, "chunk long, id long, n long, s1 long, s2 long"))
    per_chunk = rows.groupBy("chunk")

    able = docs.filter("n > 0 and id is not null")
    # Repeated ids lie in one chunk, so the smallest id brings its own chunk along.
    lead = able.groupBy("s1", "s2", "n").agg(F.min(F.struct("id", "chunk")).alias("m"))
    lead = saved(lead.select("m.id", "m.chunk", "s1", "s2", "n"))
    told = lead.select("chunk", "id", "s1", "s2")
    buckets = bucket_count(df, lead.agg(F.sum("n")).first()[0])
    answers = shared_cells(per_chunk.cogroup(told.groupBy("chunk")).applyInPandas(_offer(buckets), CELL_SCHEMA))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")  # no nulls in number columns for pandas
    told = told.select("*", F.lit(-1).alias("bucket"), none.alias("bits")).unionByName(
        answers.select("chunk", zero.alias("id"), zero.alias("s1"), zero.alias("s2"), "bucket", "bits"))
    classes = saved(per_chunk.cogroup(told.groupBy("chunk")).applyInPandas(
        _survivors(buckets), "id long, n long, hashes array<long>"))

    comp = _class_components(classes)
    member = able.select("id", "s1", "s2", "n").distinct().join(
        lead.select("s1", "s2", "n", F.col("id").alias("rep")), ["s1", "s2", "n"])
    # An id on several rows with different sets belongs to all their classes.
    of_id = member.join(comp.withColumnRenamed("id", "rep"), "rep", "left").groupBy("id").agg(
        F.min(F.coalesce("component", "rep")).alias("component"))
    return docs.select("id", "n").join(of_id, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))
