"""Vocabulary files, pre-tokens and a cache shared by the tokenizing operators."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex

#: Pre-tokens kept per Python worker; the cache only saves time.
CACHE_TOKENS = 250_000

#: Fixed value: the pre-token pattern of the byte-level vocabularies.
SPACE_PREFIX_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                        r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    """``token -> rank`` of a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


def _classes() -> np.ndarray:
    """Class of every code point, by the same Unicode tables as the pattern."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
    text = points.tobytes().decode("utf-32-le")
    table = np.zeros(0x110000, np.uint8)
    for kind, expr in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(expr, text):
            table[points[m.start():m.end()]] = kind
    return table


class Pretokens:
    """Cut a text into the matches of a pattern.

    For the usual space-prefix pattern the cuts follow from runs of character
    classes, found for a whole text at once; any other pattern is matched as is.
    """

    def __init__(self, pattern: str):
        self._findall = regex.compile(pattern).findall
        self._table = _classes() if pattern == SPACE_PREFIX_PATTERN else None

    def split(self, text: str) -> list[str]:
        if self._table is None:
            return self._findall(text)
        n = len(text)
        if n < 2:
            return [text] if n else []
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = self._table[cp]
        start = np.ones(n, bool)
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        # The last blank before a word stands apart from those before it; a plain space joins the word.
        blank = kind == _SPACE
        last = blank[:-1] & ~blank[1:]
        start[:-1] |= last
        start[1:] &= ~(last & (cp[:-1] == 32))
        for i in np.flatnonzero((cp[:-1] == 39) & start[:-1] & (kind[1:] == _LETTER)).tolist():
            size = 2 if text[i + 1] in "stmd" else 3 if text[i + 1:i + 3] in ("re", "ve", "ll") else 0
            if size:
                start[i + 1] = False
                start[i + size:i + size + 1] = True
        cut = np.flatnonzero(start).tolist()
        cut.append(n)
        return [text[a:b] for a, b in zip(cut, cut[1:])]


class TokenCache:
    """Packed int32 ids of texts; ``resolve`` gives the packed ids of new pre-tokens."""

    def __init__(self, split: Pretokens, resolve: Callable[[list[str]], list[bytes]],
                 limit: int = CACHE_TOKENS):
        self._split, self._resolve, self._limit = split.split, resolve, limit
        self._known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian int32 ids of each text."""
        split = [self._split(t) for t in texts]
        known = self._known
        if len(known) > self._limit:
            known.clear()
        new = list({t for p in split for t in p if t not in known})
        known.update(zip(new, self._resolve(new)))
        return [b"".join([known[t] for t in p]) for p in split]


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut record batches so that the text of each slice stays near ``max_bytes``."""
    for batch in batches:
        col = batch.column(column)
        if batch.num_rows == 0:
            continue
        size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy())
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
            part = batch.slice(start, stop - start)
            yield part, part.column(column).to_pylist()
            start, base = stop, int(size[stop - 1])


def int_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed int32 ids as an Arrow list array."""
    ends = np.cumsum([0, *(len(b) // 4 for b in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
