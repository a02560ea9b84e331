"""Ranked lexical search (operator 12): a K2-treap over the grid of terms and documents.

Documents are cut into blocks within their scan partition. The grid of a block has
a row for each of its terms (frequent ones first, so rows of a cell are alike) and
a column for each document; a point carries the impact of the term on the score of
the document. The grid is stored as a compressed quadtree: a cell keeps the
greatest impact below it and four bits that say which quarters hold points, cells of
a level lie one after the other, and ranks of the bits lead to the quarters.

An item holds, for a range of documents, the cell on the row path of each of its
terms. The weighted sum of their maxima bounds the score of every document in the
range; ranges are halved best first, all paths descending together, until no bound
reaches the k-th best score found so far. A range of one document has its exact
score as its bound. Best scores are carried from block to block of a partition, which
sends k rows an item.

Two passes over the texts: one counts documents, terms and, for the items' terms,
the documents that hold them; the other builds each block's tree and searches it. Texts
are never shuffled and nothing is kept on disk; a lost task repeats its own
partition. Items are taken ``ITEM_BYTES`` of text at a time, so what is broadcast
and what a pass collects (a count for each of their terms) is bounded.

Null and empty texts have no terms: such documents don't count, such items find
nothing. Each row is a document of its own, also with an id that others have;
equal scores go by id, null ids last. Items equal in id and text are one item.
Empty tables give an empty result; other columns are ignored. A very long text is
a block of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from releaseflow.llm.ship import ship
from releaseflow.llm.tokens import TERM_BYTES, Tokens, parts

BLOCK_BYTES = 8 << 20
ITEM_BYTES = 16 << 20
#: Search begins with ranges of so many documents (a power of two), and halves so many ranges at once.
RANGE_DOCS, TOGETHER = 64, 128
_DOCUMENTS, _TERMS = -1, -2
_LAST_ID = np.iinfo(np.int64).max
_BELOW = np.array([[bin(m & ((1 << j) - 1)).count("1") for j in range(4)] for m in range(16)], np.int64).ravel()


def _spread(x: np.ndarray) -> np.ndarray:
    """The 32 low bits of each number with a zero before each."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


class Treap:
    """Quadtree of points ``(row, column, value)`` with the greatest value of every cell.

    Cell 0 stands for an empty one, cell 1 for the whole grid.
    """

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray):
        self.levels = max(1, int(max(row.max(initial=0), col.max(initial=0))).bit_length())
        code = (_spread(row) << np.uint64(1)) | _spread(col)
        order = np.argsort(code)
        code, best = code[order], value[order].astype(np.int64)
        masks, bests = [np.zeros(len(code), np.uint8)], [best]
        for _ in range(self.levels):
            quarter = np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)
            code = code >> np.uint64(2)
            first = np.flatnonzero(np.diff(code, prepend=code[:1] + np.uint64(1)))
            code, best = code[first], np.maximum.reduceat(best, first)
            masks.append(np.bitwise_or.reduceat(quarter, first))
            bests.append(best)
        self.mask = np.concatenate([np.zeros(1, np.uint8), *masks[::-1]])
        self.best = np.concatenate([np.zeros(1, np.int64), *bests[::-1]])
        children = np.bitwise_count(self.mask).astype(np.int64)
        self.first = np.cumsum(children) - children + 2

    def quarter(self, cell: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The given quarter (2 * lower rows + right columns) of each cell."""
        mask = self.mask[cell].astype(np.int64)
        return np.where((mask >> which) & 1, self.first[cell] + _BELOW[4 * mask + which], 0)

    def paths(self, rows: np.ndarray, size: int, ranges: int) -> np.ndarray:
        """For each row and each range of ``size`` columns, the cell of that width on the row's path."""
        depth = self.levels - (size.bit_length() - 1)
        cell = np.ones((len(rows), ranges), np.int64)
        at = np.arange(ranges)
        for level in range(depth):
            below = (rows >> (self.levels - 1 - level)) & 1
            right = (at >> (depth - 1 - level)) & 1
            cell = self.quarter(cell, 2 * below[:, None] + right[None, :])
        return cell

    def search(self, rows: np.ndarray, weight: np.ndarray, cells: np.ndarray, size: int, k: int,
               best: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores and ids, in order) together with this grid's columns, cut to k."""
        score, who = best
        floor = int(score[k - 1]) if len(score) >= k else 1
        level = np.full(cells.shape[1], self.levels - (size.bit_length() - 1))
        col = np.arange(cells.shape[1])
        bound = weight @ self.best[cells]
        while True:
            done = level == self.levels
            hit = done & (bound >= floor)
            if hit.any():
                score, who = np.append(score, bound[hit]), np.append(who, ids[col[hit]])
                order = np.lexsort((who, -score))[:k]
                score, who = score[order], who[order]
                floor = int(score[k - 1]) if len(score) >= k else 1
            live = ~done & (bound >= floor)
            if not live.all():
                level, col, bound, cells = level[live], col[live], bound[live], cells[:, live]
            if not len(bound):
                return score, who
            if len(bound) > TOGETHER:
                order = np.argpartition(-bound, TOGETHER)
                now, later = order[:TOGETHER], order[TOGETHER:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            below = 2 * ((rows[:, None] >> (self.levels - 1 - level[now])[None, :]) & 1)
            halves = np.concatenate([self.quarter(cells[:, now], below), self.quarter(cells[:, now], below + 1)],
                                    axis=1)
            level = np.concatenate([level[later], level[now] + 1, level[now] + 1])
            col = np.concatenate([col[later], 2 * col[now], 2 * col[now] + 1])
            bound = np.concatenate([bound[later], weight @ self.best[halves]])
            cells = np.concatenate([cells[:, later], halves], axis=1)


@dataclass
class Items:
    """Items of one block: ids, and their terms with the number of repeats."""

    ids: list[int | None]
    terms: pa.Array
    of: np.ndarray  # start of each item in the next two, and the end of the last
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of_rows(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        tokens = Tokens.of(pa.array([t for _, t in rows], pa.string()), TERM_BYTES)
        many = max(1, len(tokens.words))
        pair, times = np.unique(tokens.owner() * many + tokens.ids, return_counts=True)
        return cls([i for i, _ in rows], tokens.words, np.searchsorted(pair // many, np.arange(len(rows) + 1)),
                   pair % many, times.astype(np.int64))


def _numbers_in(words: pa.Array, terms: pa.Array) -> np.ndarray:
    """The number in ``terms`` of each word, -1 if it is none of them."""
    return pc.fill_null(pc.index_in(words, value_set=terms), -1).to_numpy().astype(np.int64)


def _counts(df: DataFrame, text_col: str, terms: pa.Array) -> dict[int, int]:
    """Documents with a term, terms with repeats, and documents holding each of ``terms``."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held = np.zeros(len(known), np.int64)
        docs = total = 0
        for part in parts(batches, text_col, BLOCK_BYTES):
            tokens = Tokens.of(part.column(text_col), TERM_BYTES)
            docs += int((np.diff(tokens.start) > 0).sum())
            total += len(tokens.ids)
            term = _numbers_in(tokens.words, known)[tokens.ids] if len(tokens.ids) else np.zeros(0, np.int64)
            asked = term >= 0
            pair = np.unique(term[asked] * part.num_rows + tokens.owner()[asked])
            held += np.bincount(pair // part.num_rows, minlength=len(known))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append([_DOCUMENTS, _TERMS], some)), pa.array(np.append([docs, total], held[some]))],
            names=["what", "n"])

    rows = df.mapInArrow(work, "what long, n long").groupBy("what").agg(F.sum("n").alias("n")).collect()
    return {r["what"]: r["n"] for r in rows}


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What one occurrence count adds to a score for each unit of the term's weight."""
    m = 75 + (25 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _grid(tokens: Tokens, documents: int, terms: int) -> tuple[np.ndarray, Treap]:
    """Row of each distinct word, and the tree of a block."""
    n = np.diff(tokens.start)
    pair, tf = np.unique(tokens.ids.astype(np.int64) * len(n) + tokens.owner(), return_counts=True)
    term, doc = pair // len(n), pair % len(n)
    order = np.argsort(-np.bincount(term, minlength=len(tokens.words)), kind="stable")
    row = np.empty(len(order), np.int64)
    row[order] = np.arange(len(order))
    return row, Treap(row[term], doc, impacts(tf, n[doc], documents, terms))


def _search_block(df: DataFrame, items: Items, k: int, id_col: str, text_col: str) -> DataFrame:
    sc = df.sparkSession.sparkContext
    count = _counts(df.select(text_col), text_col, items.terms)
    documents, terms = count.get(_DOCUMENTS, 0), count.get(_TERMS, 0)
    weight = np.array([term_weight(documents, count[t]) if t in count else 0
                       for t in range(len(items.terms))], np.int64)
    shared = sc.broadcast((items, weight))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked.ids]
        for part in parts(batches, text_col, BLOCK_BYTES):
            tokens = Tokens.of(part.column(text_col), TERM_BYTES)
            if not len(tokens.ids):
                continue
            row, tree = _grid(tokens, documents, terms)
            ids = pc.fill_null(part.column(id_col), _LAST_ID).to_numpy()
            size = min(RANGE_DOCS, 1 << tree.levels)
            ranges = min(-(-part.num_rows // size), (1 << tree.levels) // size)  # the last documents may be empty
            number = _numbers_in(tokens.words, asked.terms)
            place = np.full(len(asked.terms), -1)
            place[number[number >= 0]] = np.flatnonzero(number >= 0)
            here = np.flatnonzero((place >= 0) & (weights > 0))
            paths = tree.paths(row[place[here]], size, ranges)
            line = np.full(len(asked.terms), -1)
            line[here] = np.arange(len(here))
            for i in range(len(best)):
                own = slice(asked.of[i], asked.of[i + 1])
                at = line[asked.term[own]]
                found = at >= 0
                at, times = at[found], asked.times[own][found]
                if len(at):
                    term = here[at]
                    best[i] = tree.search(row[place[term]], weights[term] * times, paths[at], size, k, best[i], ids)
        size = [len(s) for s, _ in best]
        docs = np.concatenate([np.zeros(0, np.int64), *(d for _, d in best)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), size)),
             pa.array([i for i, n in zip(asked.ids, size) for _ in range(n)], pa.int64()),
             pa.array(docs, mask=docs == _LAST_ID),
             pa.array(np.concatenate([np.zeros(0, np.int64), *(s for s, _ in best)]))],
            names=["item", "item_id", "doc_id", "score"])

    rows = df.select(F.col(id_col).cast("long").alias(id_col), text_col)
    found = rows.mapInArrow(work, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id",
                     text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k documents of highest score above 0 for each item."""
    spark = docs.sparkSession
    ship(spark)
    items = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    found = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        if rows:
            found.append(_search_block(docs, Items.of_rows([(r[0], r[1]) for r in rows]), k, id_col, text_col))
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found) if found else empty
