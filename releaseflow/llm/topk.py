"""Exact top-k inner products (operator 6): columnar branch-and-bound.

Vectors are kept in blocks in vertical layout (dimension by row): ``ROWS``
candidates or ``QUERIES`` queries (fewer if that makes more than ``LARGEST``
components), as whole numbers no wider than they need. A
task holds one group of queries, at most about ``HELD`` bytes of them, and lets
one group of candidate blocks pass; every pair of groups is one task. A query
keeps the k best of all blocks it has met, and the least of them is its floor.

Products of a block are found for ``QUERIES`` queries at a time. The product over
the first ``DIMS`` (or twice, four times as many) dimensions plus the largest
product the remaining mass allows (norm of the query's rest times norm of the
candidate's rest) drops the pairs that stay below the floor, if a sample of the
queries shows that few pairs are left; these get their exact product one by one.
Else whole products are cheaper and all pairs get theirs.

Each task sends k rows per query it holds; a ranked window keeps the k best.
Queries are copied once per group of candidates and candidates once per group of
queries; there are as many tasks as the session has shuffle partitions, unless
copies of queries would then weigh more than half of those of candidates.

Null ids, null vectors and vectors with null or non-finite components take no
part. Vectors are compared with those of the same length only. Ties go to the
smaller id; rows with the query's own id are no candidates for it, and repeated
rows count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from releaseflow.llm.ship import ship

ROWS, QUERIES, DIMS, HELD, LARGEST = 4096, 256, 16, 32 << 20, 1 << 22
#: Share of pairs left from which on whole products are cheaper; queries in the sample that tells.
FEW, SAMPLE = 1 / 128, 64


def _quantised(vec: str) -> Column:
    return F.transform(vec, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def _finite(vec: str) -> Column:
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
                      F.lit(False))


def _narrow(m: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    return m.astype(next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _pack(rows: int, queries: int):
    """Rows of a partition as blocks of candidates, and once more those that ask as blocks of queries.

    ``nth`` numbers the blocks of either kind, from the partition's number on, so that all groups get about as many.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bool, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        nth = dict.fromkeys((False, True), TaskContext.get().partitionId())

        def block(asked: bool, dim: int) -> pa.RecordBatch:
            ids, m = map(np.concatenate, zip(*held.pop((asked, dim))))
            m = np.ascontiguousarray(_narrow(m).T)
            nth[asked] += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([asked]), pa.array([nth[asked] - 1], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([m.itemsize], pa.int32()), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                 pa.array([m.tobytes()], pa.binary())], names=["asked", "nth", "dim", "width", "ids", "m"])

        for batch in batches:
            ids, dims = batch.column("id").to_numpy(), batch.column("dim").to_numpy()
            asks = batch.column("asks").fill_null(False).to_numpy(zero_copy_only=False)
            ends, values = np.cumsum(dims, dtype=np.int64), batch.column("v").flatten().to_numpy()
            for dim in np.unique(dims).tolist():
                for asked, most in ((False, rows), (True, queries)):
                    size = max(1, min(most, LARGEST // dim))
                    at = np.flatnonzero((dims == dim) & (asks if asked else True))
                    while len(at):
                        part = held.setdefault((asked, dim), [])
                        room = size - sum(len(i) for i, _ in part)
                        now, at = at[:room], at[room:]
                        part.append((ids[now], values[(ends[now] - dim)[:, None] + np.arange(dim)]))
                        if len(now) == room:
                            yield block(asked, dim)
        for key in sorted(held):
            yield block(*key)

    return run


def _rest(m: np.ndarray, d: int) -> np.ndarray:
    """Norm of each column from dimension ``d`` on."""
    return np.sqrt((m[d:].astype(np.float64) ** 2).sum(axis=0))


def _reach(products: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the products that reach the floor of their row."""
    rows = np.flatnonzero(products.max(axis=1) >= floor)
    row, col = np.divmod(np.flatnonzero(products[rows] >= floor[rows, None]), products.shape[1])
    return rows[row], col


class _Queries:
    """Queries of one length in vertical layout with the k best candidates of each so far."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], k: int):
        self.ids = np.concatenate([i for i, _ in parts])
        self.m, self.k, n = np.concatenate([m for _, m in parts], axis=1), k, len(self.ids)
        self.top = max(float(_rest(self.m[:, a:a + ROWS], 0).max()) for a in range(0, n, ROWS))
        self.n, self.best, self.who = np.zeros(n, np.int64), np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def meet(self, ids: np.ndarray, m: np.ndarray) -> None:
        """Lets a block of candidates pass."""
        mass = self.top * float(_rest(m, 0).max())
        # Whole products, and with them all partial sums, are at most the product of the norms.
        kind = np.float32 if mass < 0.99 * 2**24 else np.float64 if mass < 0.99 * 2**53 else np.int64
        cand = m.astype(kind)
        seeded = self.n == self.k
        head = None
        if kind != np.int64 and seeded.any():
            some = np.flatnonzero(seeded)
            head = self._few(some[::-(-len(some) // SAMPLE)], m, cand, mass)
        for a in range(0, len(self.ids), QUERIES):
            at = np.arange(a, min(a + QUERIES, len(self.ids)))
            q = self.m[:, a:a + QUERIES].astype(kind)
            if head is not None and seeded[at].all():
                row, col = _reach(*self._most(at, q, *head, mass))
                score = np.empty(len(row), kind)
                for i in range(0, len(row), 1 << 16):
                    j = slice(i, i + (1 << 16))
                    score[j] = np.einsum("ij,ij->j", q[:, row[j]], cand[:, col[j]])
                good = score >= self.best[at, -1].astype(kind)[row]
                row, col, score = row[good], col[good], score[good]
            else:
                found = q.T @ cand
                row, col = _reach(found, self._floor(at, found, ids))
                score = found[row, col]
            if len(row):
                self._take(at[row], ids[col], score.astype(np.int64))

    def _few(self, some: np.ndarray, m: np.ndarray, cand: np.ndarray, mass: float):
        """The first dimensions after which few pairs are left, as candidates with their norm of the rest; or None."""
        q, d = self.m[:, some].astype(cand.dtype), DIMS
        while d < len(m):
            head = d, np.vstack([cand[:d], _rest(m, d).astype(cand.dtype)[None]])
            most, floor = self._most(some, q, *head, mass)
            if (most >= floor[:, None]).mean() <= FEW:
                return head
            d *= 2
        return None

    def _most(self, at: np.ndarray, q: np.ndarray, d: int, head: np.ndarray,
              mass: float) -> tuple[np.ndarray, np.ndarray]:
        """Partial products with the most that the rest allows, and the floors to reach."""
        most = np.vstack([q[:d], _rest(self.m[:, at], d).astype(q.dtype)[None]]).T @ head
        slack = 1 + 4 * (d + 2) * float(np.finfo(q.dtype).eps) * mass  # rounding of norms and sums
        return most, (self.best[at, -1] - slack).astype(q.dtype)

    def _floor(self, at: np.ndarray, found: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The least product of interest of each query: its k-th best so far, or in part of the block if it has none."""
        floor, new = self.best[at, -1].astype(found.dtype), np.flatnonzero(self.n[at] < self.k)
        if len(new):
            least = -np.inf if found.dtype.kind == "f" else np.iinfo(found.dtype).min
            floor[new] = least
            if len(ids) > self.k:
                part = max(512, 4 * self.k)
                others = np.where(ids[:part] == self.ids[at[new], None], least, found[new, :part])
                floor[new] = np.partition(others, -self.k, axis=1)[:, -self.k]
        return floor

    def _take(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """Merges pairs into the best of their queries."""
        good = (self.n[row] < self.k) | (score > self.best[row, -1]) | (ids < self.who[row, -1])
        good &= ids != self.ids[row]
        row, ids, score = row[good], ids[good], score[good]
        rows = np.unique(row)
        old, slot = np.nonzero(np.arange(self.k) < self.n[rows, None])
        row = np.concatenate([rows[old], row])
        ids = np.concatenate([self.who[rows[old], slot], ids])
        score = np.concatenate([self.best[rows[old], slot], score])
        order = np.lexsort((ids, ~score, row))  # not score: falls as score grows, also at the ends of the range
        row, ids, score = row[order], ids[order], score[order]
        slot = np.arange(len(row)) - np.searchsorted(row, row)
        keep = slot < self.k
        row, slot = row[keep], slot[keep]
        self.who[row, slot], self.best[row, slot] = ids[keep], score[keep]
        np.maximum.at(self.n, row, slot + 1)

    def found(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.ids), ROWS):
            row, slot = np.nonzero(np.arange(self.k) < self.n[a:a + ROWS, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[a + row]), pa.array(self.who[a + row, slot]), pa.array(self.best[a + row, slot])],
                names=["query_id", "vec_id", "score"])


def _search(k: int):
    """One cell: its blocks of queries, then its blocks of candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[int, _Queries] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                asked, dim, width = (batch.column(c)[i].as_py() for c in ("asked", "dim", "width"))
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), "<i8")
                m = np.frombuffer(batch.column("m")[i].as_buffer(), f"<i{width}").reshape(dim, -1)
                if asked:
                    parts.setdefault(dim, []).append((ids, m))
                    continue
                if dim in parts:
                    held[dim] = _Queries(parts.pop(dim), k)
                if dim in held:
                    held[dim].meet(ids, m)
        for queries in held.values():
            yield from queries.found()

    return run


def _grid(rows: int, parts: int, weight: int, asked: int) -> tuple[int, int]:
    """Groups of candidates and of queries, from components of all vectors and of those that ask."""
    queries = max(1, -(-2 * asked // HELD))
    return max(1, min(parts // queries, rows // (4 * ROWS), weight * queries // (2 * max(1, asked)))), queries


def top_products(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest products for each query row."""
    ship(df.sparkSession)
    spark = df.sparkSession
    given = (df.filter(F.col(id_col).isNotNull() & (F.size(vec_col) > 0))
             .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("e"), queries.alias("asks")))
    size = F.size("e").cast("long")
    n, weight, asked = given.agg(F.count(size), F.sum(size), F.sum(F.when(F.col("asks"), size))).first()
    cand_groups, query_groups = _grid(n, int(spark.conf.get("spark.sql.shuffle.partitions")), weight or 0, asked or 0)
    rows = (given.filter(_finite("e")).select("id", _quantised("e").alias("v"), "asks")
            .withColumn("dim", F.size("v")).dropDuplicates(["id", "v"]).sortWithinPartitions("id", "v"))
    blocks = rows.mapInArrow(_pack(ROWS, QUERIES), "asked boolean, nth long, dim int, width int, ids binary, m binary")
    cell = F.when(F.col("asked"), F.transform(F.sequence(F.lit(0), F.lit(cand_groups - 1)), lambda c: (
        c * query_groups + F.pmod("nth", F.lit(query_groups))).cast("int"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(query_groups - 1)), lambda q: (
            F.pmod("nth", F.lit(cand_groups)) * query_groups + q).cast("int")))
    found = (blocks.withColumn("cell", F.explode(cell)).repartitionById(cand_groups * query_groups, F.col("cell"))
             .sortWithinPartitions(F.desc("asked")).select("asked", "dim", "width", "ids", "m")
             .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
