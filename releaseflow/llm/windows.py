"""Word windows of document chunks, and which window hashes several chunks share.

Documents are dealt by id into chunks of about ``CHUNK_DOCS`` consecutive ids. A
chunk sends its window hashes to hash buckets as sorted lists of small
differences (about two and a half bytes a window instead of a row), the bucket
answers with one bit per hash, and the chunk carries on with its own texts. No
list grows with one passage: a chunk sends each hash once, however often it
holds it.

Hashes are cut to ``CELL_BITS`` bits within a bucket here, so the answer may name
a few windows too many, never one too few; callers check further.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_DOCS = 256
#: Stretches of the id range, told apart by quantiles; within one, ids are taken as evenly spread.
STRETCHES = 256
CELL_BITS = 26
#: Windows that a bucket holds at most, about: its one task needs some 200 MB for them, and cells of 26 bits seldom clash.
BUCKET_WINDOWS = 1 << 21
_STEP = 0xFFFF

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _A + right * _B)


@dataclass
class Words:
    """The words of several documents, one after the other."""

    words: list[bytes]
    start: np.ndarray  # of each document, and the end of the last
    hashes: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], lower: bool = False) -> Words:
        """Words are runs of bytes other than blank, tab and line breaks (0x09-0x0D)."""
        per = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        per = [(b.lower() if lower else b).split() for b in per]
        flat = [w for p in per for w in p]
        arr = np.empty(len(flat), dtype=object)
        arr[:] = flat
        hashes = pd.util.hash_array(arr, categorize=False) if flat else np.zeros(0, np.uint64)
        return cls(flat, np.cumsum([0, *map(len, per)]), hashes)

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each position; meaningful where ``fits`` holds."""
        n, power, have = len(self.hashes), 1, self.hashes
        done, got = 0, None
        while True:  # binary expansion of the size, small parts first
            if size & power:
                part = np.zeros(n, np.uint64)
                part[:max(0, n - done)] = have[done:]
                got = part if got is None else _pair(got, part)
                done += power
            if done == size:
                return got
            nxt = np.zeros(n, np.uint64)
            nxt[:max(0, n - power)] = _pair(have[:max(0, n - power)], have[power:])
            have, power = nxt, 2 * power

    def fits(self, size: int) -> np.ndarray:
        """Whether a window of ``size`` words from each position stays in its document."""
        ends = np.repeat(self.start[1:], np.diff(self.start))
        return np.arange(len(self.hashes)) + size <= ends

    def offset(self) -> np.ndarray:
        """Position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.start[:-1], np.diff(self.start))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def _stretches(df: DataFrame, id_col: str) -> list[tuple[int, int, int]]:
    """``(first id, id width of a chunk, first chunk)`` of stretches with equal shares of the rows."""
    shares = [k / STRETCHES for k in range(1, STRETCHES)]
    low, high, n, inner = df.agg(F.min(id_col).cast("long"), F.max(id_col).cast("long"), F.count(id_col),
                                 F.percentile_approx(F.col(id_col).cast("long"), shares)).first()
    if not n:
        return [(0, 1, 0)]
    step = max(1, -(-STRETCHES * CHUNK_DOCS // n))  # a small table needs fewer stretches
    edges = sorted({low, *inner[step - 1::step]})
    per = max(1, round(n / len(edges) / CHUNK_DOCS))
    return [(lo, -(-(hi - lo) // per), per * k) for k, (lo, hi) in enumerate(zip(edges, [*edges[1:], high + 1]))]


def chunked(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``(chunk, id, text)`` and ``more``; chunks follow the order of ids, null ids come first.

    Quantiles of the ids cut the table into stretches of equal shares, so a few ids
    far from all others don't widen the chunks of the rest.
    """
    def number(x: int) -> Column:
        return F.lit(str(x)).cast("decimal(20,0)")

    known = F.array(*(F.struct(number(lo).alias("lo"), number(width).alias("width"), F.lit(k).cast("long").alias("k"))
                      for lo, width, k in _stretches(df, id_col)))
    own = F.col(id_col).cast("decimal(20,0)")
    at = F.slice(F.filter(known, lambda s: s["lo"] <= own), -1, 1)
    chunk = F.get(F.transform(at, lambda s: s["k"] + F.floor((own - s["lo"]) / s["width"]).cast("long")), 0)
    nulls = F.pmod(F.xxhash64(text_col), F.lit(4096)) - F.lit(1 << 62)
    return df.select(F.coalesce(chunk, nulls).alias("chunk"), F.col(id_col).cast("long").alias("id"),
                     F.col(text_col).alias("text"), *more)


def in_order(docs: pd.DataFrame) -> pd.DataFrame:
    """Rows of a chunk by id (null first), then text."""
    return docs.sort_values(["id", "text"], na_position="first", kind="stable", ignore_index=True)


def bucket_count(df: DataFrame, windows: int | None) -> int:
    """Buckets of about ``BUCKET_WINDOWS`` of all windows at most; several for each task of a shuffle."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * tasks, -(-(windows or 0) // BUCKET_WINDOWS))


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells as 16-bit differences; a larger one is spread over several."""
    steps, last = np.divmod(np.diff(cells, prepend=0).astype(np.int64), _STEP)
    out = np.full(int(steps.sum()) + len(cells), _STEP, "<u2")
    out[np.cumsum(steps + 1) - 1] = last
    return out.tobytes()


def unpack_cells(blob: bytes) -> np.ndarray:
    parts = np.frombuffer(blob, "<u2")
    return np.cumsum(parts, dtype=np.int64)[parts != _STEP]


class Cells:
    """A chunk's distinct hashes in the order in which buckets see them."""

    def __init__(self, hashes: np.ndarray, buckets: int):
        self.place = hashes % np.uint64(buckets << CELL_BITS)
        self.order = np.argsort(self.place, kind="stable")
        self.sorted = self.place[self.order].astype(np.int64)
        self.edges = np.searchsorted(self.sorted, np.arange(buckets + 1, dtype=np.int64) << CELL_BITS)

    def rows(self, chunk: int, several: np.ndarray, anchor: np.ndarray) -> pd.DataFrame:
        """One row per bucket: its cells, which of them are met several times, which are anchors."""
        several, anchor = several[self.order], anchor[self.order]
        out = []
        for b in np.flatnonzero(np.diff(self.edges)).tolist():
            lo, hi = self.edges[b], self.edges[b + 1]
            out.append((b, chunk, int(hi - lo), pack_cells(self.sorted[lo:hi] & ((1 << CELL_BITS) - 1)),
                        np.packbits(several[lo:hi]).tobytes(), np.packbits(anchor[lo:hi]).tobytes()))
        return pd.DataFrame(out, columns=["bucket", "chunk", "n", "cells", "several", "anchor"])

    def answers(self, rows: pd.DataFrame) -> np.ndarray:
        """The buckets' bits, for the hashes as given."""
        hit = np.zeros(len(self.order), bool)
        for b, bits in zip(rows["bucket"], rows["bits"]):
            lo, hi = self.edges[b], self.edges[b + 1]
            hit[self.order[lo:hi]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        return hit


CELL_SCHEMA = "bucket int, chunk long, n int, cells binary, several binary, anchor binary"


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Per chunk: which cells an anchor holds and more than one window has."""
    size = rows["n"].to_numpy()
    cells = np.concatenate([unpack_cells(c) for c in rows["cells"]])
    several, anchor = (np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n)
                                       for b, n in zip(rows[col], size)]) for col in ("several", "anchor"))
    _, inv, count = np.unique(cells, return_inverse=True, return_counts=True)
    many = (count > 1) | (np.bincount(inv, several) > 0)
    hit = (many & (np.bincount(inv, anchor) > 0))[inv]
    parts = np.split(hit, np.cumsum(size)[:-1])
    keep = [k for k, p in enumerate(parts) if p.any()]
    return pd.DataFrame({"chunk": rows["chunk"].to_numpy()[keep], "bucket": rows["bucket"].to_numpy()[keep],
                         "bits": [np.packbits(parts[k]).tobytes() for k in keep]})


def shared_cells(cells: DataFrame) -> DataFrame:
    """``(chunk, bucket, bits)``: the answers to rows of ``CELL_SCHEMA``."""
    return cells.groupBy("bucket").applyInPandas(_meet, "chunk long, bucket int, bits binary")


def texts_of(docs: pd.DataFrame) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in docs["text"]]

