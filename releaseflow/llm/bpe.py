"""Byte-level BPE encoding and decoding (operator 1).

Two tiers: a minimal perfect hash over the vocabulary resolves whole pre-tokens
that are tokens themselves; every other pre-token is merged with a heap over a
linked list of its bytes. The vocabulary is the only thing sent to executors;
its size is fixed by the rank file.

Null texts count as empty and give no ids. Input columns other than the id and
the text are ignored, so clashing names do no harm; repeated rows each give
their own row; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from releaseflow.llm.ship import ship
from releaseflow.llm.vocab import Pretokens, TokenCache, int_lists, read_ranks, slices

_LAMBDA = 4  # keys per bucket of the perfect hash


def _hash(keys: list) -> np.ndarray:
    arr = np.empty(len(keys), dtype=object)
    arr[:] = keys
    return pd.util.hash_array(arr, categorize=False)


class MinimalPerfectHash:
    """Hash-and-displace: ``len(keys)`` slots, one key each.

    A key with 64-bit hash h falls into bucket ``h % buckets``; its slot is
    ``(a(h) * d0 + b(h) + d1) % n`` with the bucket's displacement (d0, d1).
    """

    def __init__(self, keys: list[str | bytes]):
        self.n = n = len(keys)
        h = _hash(keys)
        if len(np.unique(h)) != n:
            raise ValueError("vocabulary keys collide in 64 bits")
        self.buckets = max(1, n // _LAMBDA)
        bucket, a, b = self._parts(h)
        self.d0 = np.zeros(self.buckets, np.int64)
        self.d1 = np.zeros(self.buckets, np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(ends)
        slot = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        rng = np.random.default_rng(11)
        for bk in np.argsort(-sizes, kind="stable"):
            if sizes[bk] < 2:
                break
            members = order[ends[bk]:ends[bk + 1]]
            trials = 8
            while True:  # a growing block of displacement trials at a time
                trials = min(2 * trials, 4096)
                d0 = rng.integers(1, n, trials)
                d1 = rng.integers(0, n, trials)
                at = (a[members][None] * d0[:, None] + b[members][None] + d1[:, None]) % n
                at.sort(axis=1)
                ok = free[at].all(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
                if ok.any():
                    t = int(np.argmax(ok))
                    self.d0[bk], self.d1[bk] = d0[t], d1[t]
                    at = (a[members] * d0[t] + b[members] + d1[t]) % n
                    slot[members], free[at] = at, False
                    break
        singles = order[ends[:-1][sizes == 1]]
        empty = np.flatnonzero(free)
        self.d1[bucket[singles]] = (empty - b[singles]) % n  # d0 = 0: the slot is chosen outright
        slot[singles] = empty
        self.keys = np.empty(n, dtype=object)
        self.keys[slot] = np.array(keys, dtype=object)
        self.key_at = np.empty(n, np.int64)
        self.key_at[slot] = np.arange(n)

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.uint64(self.n)
        return ((h % np.uint64(self.buckets)).astype(np.int64),
                ((h >> np.uint64(20)) % n).astype(np.int64),
                ((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) % n).astype(np.int64))

    def find(self, queries: list[str | bytes]) -> np.ndarray:
        """Index of each query among the keys, -1 for strangers."""
        if not queries or not self.n:
            return np.full(len(queries), -1, np.int64)
        bucket, a, b = self._parts(_hash(queries))
        at = (a * self.d0[bucket] + b + self.d1[bucket]) % self.n
        asked = np.empty(len(queries), dtype=object)
        asked[:] = queries
        return np.where(self.keys[at] == asked, self.key_at[at], -1)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        tokens = list(ranks)
        self._hash = MinimalPerfectHash(tokens)
        self._rank_of = np.array([ranks[t] for t in tokens], np.int32)
        self._token_of = {r: t for t, r in ranks.items()}
        self._cache = None

    def __getstate__(self):
        return self.__dict__ | {"_cache": None}

    def _merge(self, word: bytes) -> bytes:
        """Merge the lowest-ranked neighbours, leftmost first, over linked bytes."""
        rank, n = self.ranks.get, len(word)
        end = list(range(1, n + 1))      # part i covers word[i:end[i]]; end[i] < 0 once swallowed
        before = list(range(-1, n - 1))  # start of the part to the left
        heap = []
        for i in range(n - 1):
            r = rank(word[i:i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or end[mid] != e:
                continue
            end[i], end[mid] = e, -1
            if e < n:
                before[e] = i
                far = end[e]
                r = rank(word[i:far])
                if r is not None:
                    heapq.heappush(heap, (r, i, far))
            p = before[i]
            if p >= 0:
                r = rank(word[p:e])
                if r is not None:
                    heapq.heappush(heap, (r, p, e))
        ids, i = [], 0
        while i < n:
            ids.append(rank(word[i:end[i]]))
            i = end[i]
        return array("i", ids).tobytes()

    def _resolve(self, tokens: list[str]) -> list[bytes]:
        raw = [t.encode() for t in tokens]
        at = self._hash.find(raw)
        ids = self._rank_of[at].astype("<i4").tobytes()
        return [ids[4 * k:4 * k + 4] if hit >= 0 else self._merge(raw[k])
                for k, hit in enumerate(at.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian int32 ids of each text."""
        if self._cache is None:  # made where it is used; classes and cache don't travel
            self._cache = TokenCache(Pretokens(self.pattern), self._resolve)
        return self._cache.encode(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids."""
        return b"".join(map(self._token_of.__getitem__, ids.tolist()))


def encode_documents(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", decode: bool = False) -> DataFrame:
    """``(id, ids array<int>[, decoded binary])``, one row per input row.

    One pass over the scan, no shuffle. ``decode`` adds the bytes that the ids
    decode to.
    """
    ship(df.sparkSession)
    coder = df.sparkSession.sparkContext.broadcast(ByteBpe(read_ranks(rank_file), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder.value
        for part, texts in slices(batches, text_col):
            packed = bpe.encode([t or "" for t in texts])
            out = {id_col: part.column(id_col), "ids": int_lists(packed)}
            if decode:
                out["decoded"] = pa.array([bpe.decode(np.frombuffer(p, "<i4")) for p in packed], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(
        run, f"{id_col} {kind}, ids array<int>" + (", decoded binary" if decode else ""))


def decode_ids(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``(id, decoded binary)`` of rows holding id arrays; a null array gives null."""
    ship(df.sparkSession)
    coder = df.sparkSession.sparkContext.broadcast(ByteBpe(read_ranks(rank_file), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(ids_col)
            out = [None if not r.is_valid else coder.value.decode(r.values.to_numpy(zero_copy_only=False))
                   for r in rows]
            yield pa.RecordBatch.from_pydict({id_col: batch.column(id_col), "decoded": pa.array(out, pa.binary())})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"{id_col} {kind}, decoded binary")
