"""Near-duplicate embeddings (operator 2).

Random-hyperplane sign hashing in several tables proposes candidates; within a
bucket every pair is verified by its exact cosine in double precision; links are
joined into components with distributed star contraction.

Vectors that are equal under one label are one class: it is hashed and compared
once, counts as often as it has ids, and its ids share a component. So copies,
however many, cost no more than their rows.

Pairs never leave a task: a bucket's task sends, for each class, how many ids
it found linked and the smallest id of its local component. A pair that shares buckets
in several tables is counted in the first one only. Buckets of more than
``BLOCK`` classes are split into blocks, each pair of blocks a task of its own.

The hash has about as many bits as the number of classes (``LEAST_BITS`` at least), so a bucket holds few
strangers at any size; the number of tables follows, so that a pair at cosine 0.98
is met with probability ``1 - MISSED`` at least, closer pairs more surely (16 bits, 22 tables up to 65,536 classes).

Vectors that are null, zero, or hold null or non-finite components, and rows with
a null label or id, link with nothing; a null id has a null component and is
kept. Vectors of different length are never compared. Repeated rows count as one
vector and each give their own result row; an id with several vectors never links with itself.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.llm.components import connected_components, saved
from releaseflow.llm.groups import local_roots, runs
from releaseflow.llm.ship import ship

BLOCK, SEED = 512, 17
#: Bits of a hash at least and at most; share of pairs at cosine 0.98 that no table may meet.
LEAST_BITS, MOST_BITS, MISSED = 16, 30, 2e-4
#: Chance that two vectors at cosine 0.98 lie on one side of a random hyperplane.
_SAME_SIDE = 1 - np.arccos(0.98) / np.pi
#: Classes with at least this share of all rows are joined back by broadcast: there are at most 1 / share.
HOT_SHARE = 1e-4


def hash_shape(classes: int) -> tuple[int, int]:
    """``(bits, tables)`` for so many classes."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(max(classes, 1))))))
    return bits, int(np.ceil(np.log(MISSED) / np.log1p(-_SAME_SIDE ** bits)))


def usable(vec: str) -> Column:
    """Non-null, non-empty vectors of finite components that are not all zero."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _signatures(m: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """``rows x tables`` sign patterns of ``bits`` bits."""
    planes = np.random.default_rng((SEED, m.shape[1])).standard_normal((m.shape[1], tables * bits))
    signs = (m @ planes >= 0).reshape(len(m), tables, bits)
    return signs @ (1 << np.arange(bits))


def _hash_rows(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vec")).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                sig = _signatures(_matrix(part.column("vec"), int(dim)), bits, tables)
                flat = pa.array(sig.ravel().astype(np.int32))
                ends = pa.array(np.arange(0, sig.size + 1, tables, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, flat)],
                                                 names=[*part.schema.names, "sig"])

    return run


def _verify(threshold: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []
        for g in runs(batches, ["key", "bi", "bj"]):
            if g.num_rows < 2:
                continue
            rep, cid, size = (g.column(c).to_numpy() for c in ("rep", "cid", "size"))
            vecs = g.column("vec").combine_chunks()
            m = _matrix(vecs, len(vecs[0]))
            m /= np.sqrt((m * m).sum(axis=1))[:, None]
            table = g.column("tab")[0].as_py()
            if g.column("bi")[0] == g.column("bj")[0]:
                a, b = np.nonzero(np.triu(m @ m.T >= threshold, 1))
            else:
                left = g.column("blk").to_numpy() == g.column("bi")[0].as_py()
                ia, ib = np.flatnonzero(left), np.flatnonzero(~left)
                a, b = np.nonzero(m[ia] @ m[ib].T >= threshold)
                a, b = ia[a], ib[b]
            if not len(a):
                continue
            sig = g.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, tables)[:, :table]
            new = ~(sig[a] == sig[b]).any(axis=1)
            n = (np.bincount(a[new], size[b[new]], minlength=len(cid))
                 + np.bincount(b[new], size[a[new]], minlength=len(cid))).astype(np.int64)
            root = local_roots(len(cid), a, b, rep)
            met = np.zeros(len(cid), bool)
            met[a] = met[b] = True
            none = np.zeros(int(met.sum()), np.int64)
            out.append((cid[met], rep[met], n[met], root[met], none, none.astype(bool)))
            # Pairs of classes that may hold one id both: that id must not count as its own partner.
            shared = g.column("shared").to_numpy(zero_copy_only=False).astype(bool)
            twin = new & shared[a] & shared[b]
            for x, y in ((a[twin], b[twin]), (b[twin], a[twin])):
                out.append((cid[x], rep[x], np.zeros(len(x), np.int64), rep[x], cid[y], np.ones(len(x), bool)))
            if len(out) >= 2000:
                yield _links(out)
                out = []
        if out:
            yield _links(out)

    return run


def _links(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    cols = [pa.array(np.concatenate(c)) for c in zip(*parts)]
    return pa.RecordBatch.from_arrays(cols, names=["cid", "rep", "n", "root", "other", "pair"])


def _with_class(rows: DataFrame, per_class: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the columns of their class; rows of hot classes meet theirs by broadcast, not by shuffle."""
    hot = F.broadcast(hot)
    few = rows.join(F.broadcast(per_class.join(hot, "cid", "left_semi")), "cid")
    rest = rows.join(hot, "cid", "left_anti").join(per_class, "cid", "left")
    return few.unionByName(rest)


def embedding_components(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per input row."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                     F.col(label_col).alias("lab"))
    able = F.col("id").isNotNull() & F.col("lab").isNotNull() & usable("vec")
    cid = F.when(able, F.xxhash64("lab", "vec")).alias("cid")
    members = saved(rows.filter(able).select(cid, "id").distinct())
    sizes = members.groupBy("cid").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("rep"))
    repeated = members.groupBy("id").count().filter("count > 1").select("id")
    several = members.join(repeated, "id", "left_semi")  # classes of ids that have several vectors
    kind = df.schema[vec_col].dataType.simpleString()
    base = rows.filter(able).select(cid, "vec", F.xxhash64("lab", F.size("vec")).alias("grp")).dropDuplicates(["cid"])
    marks = several.select("cid", F.lit(True).alias("shared")).distinct()
    classes = saved(base.join(sizes, "cid").join(marks, "cid", "left").withColumn(
        "shared", F.coalesce("shared", F.lit(False))))
    bits, tables = hash_shape(classes.count())
    hashed = saved(classes.mapInArrow(_hash_rows(bits, tables), (
        f"cid long, vec {kind}, grp long, size long, rep long, shared boolean, sig array<int>")))

    keys = hashed.select("cid", "grp", F.posexplode("sig").alias("tab", "s")).select(
        "cid", "tab", F.xxhash64("grp", "tab", "s").alias("key"))
    met = keys.groupBy("key").count().filter("count > 1").select(
        "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("nb"))
    block = F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    cand = (keys.join(met, "key").select("cid", "tab", "key", block.alias("blk"), other.alias("o"))
            .select("cid", "tab", "key", "blk", F.least("blk", "o").alias("bi"), F.greatest("blk", "o").alias("bj")))
    found = saved(cand.join(hashed.select("cid", "rep", "size", "shared", "vec", "sig"), "cid")
                  .repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
                  .mapInArrow(_verify(threshold, tables),
                              "cid long, rep long, n long, root long, other long, pair boolean"))

    linked = found.groupBy("cid").agg(F.sum("n").alias("n"))
    edges = found.filter("not pair").select("rep", "root").union(
        several.join(sizes, "cid").select("id", "rep"))
    comp = connected_components(edges, "rep", "root").select(F.col("id").alias("rep"), F.col("component").alias("c"))
    per_class = saved(sizes.join(linked, "cid", "left").join(comp, "rep", "left").select(
        "cid", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("c", "rep").alias("c")))
    least = max(1000, int(members.count() * HOT_SHARE))
    hot = sizes.filter(F.col("size") >= least).select("cid")

    # An id in two linked classes is no partner of itself.
    own = (found.filter("pair").select("cid", "other").join(several, "cid")
           .join(several.select(F.col("cid").alias("other"), "id"), ["other", "id"])
           .groupBy("cid", "id").agg(F.count(F.lit(1)).alias("own")))
    placed = rows.select("id", cid)
    able_rows = _with_class(placed.filter("cid is not null"), per_class, hot).join(own, ["cid", "id"], "left")
    n_links = F.col("n_links") - F.coalesce("own", F.lit(0))
    out = able_rows.select("id", n_links.alias("n_links"), "c").unionByName(
        placed.filter("cid is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("c")))
    return out.select(F.col("id").alias(id_col), "n_links", F.col("c").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("c"), F.lit(True)).alias("kept"))
