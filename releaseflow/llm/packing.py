"""Packing documents into training windows (operator 7).

Sum-of-squares online packing: every document's remainder goes to the fill
level that keeps the sum of the squared counts of partially filled windows
smallest; the counts per level are one array of ``window + 1`` numbers. Whole
windows are cut off long documents first. When a partition ends, the windows
still open are cut and run together, and the last stretch is cut into lengths
that are powers of two, so no window needs padding.

Each task packs the documents of its own scan partition: memory is bounded by
the open windows (fewer than ``window`` levels, kept few by the rule itself),
nothing is shuffled, and a lost task repeats alone with the same result.

A null text is an empty document: just its end id. Columns other than the id and
the text are ignored; repeated rows are packed as documents of their own; an empty
table gives no pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from releaseflow.llm.ship import ship
from releaseflow.llm.vocab import Pretokens, TokenCache, read_ranks, slices


class SumOfSquares:
    """Level array of open windows; ``place(size)`` chooses one."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> list:
        """The window (a list of pieces) that takes ``size`` more ids; [] if new.

        Moving one window from level h to h + size changes the sum of squares by
        2 (count[h + size] - count[h]) + 2, by 1 - 2 count[h] when that fills it;
        a new window adds 2 count[size] + 1. Ties go to the fullest level.
        """
        w, count = self.window, self.count
        change = 2 * (count[size:w + 1] - count[:w + 1 - size]) + 2
        change[w - size] = 1 - 2 * count[w - size]
        change[count[:w + 1 - size] == 0] = 1 << 60
        change[0] = 2 * count[size] + 1
        level = w - size - int(np.argmin(change[::-1]))
        if level:
            count[level] -= 1
            win = self.open[level].pop()
        else:
            win = []
        if level + size < w:
            count[level + size] += 1
            self.open[level + size].append(win)
        return win

    def rest(self) -> list[list]:
        """The windows still open, fullest first; the packer is empty afterwards."""
        left = [win for level in reversed(self.open) for win in reversed(level)]
        self.__init__(self.window)
        return left


def _power_cuts(total: int, window: int) -> list[int]:
    """Lengths of the windows for ``total`` ids: full ones, then powers of two."""
    full, tail = divmod(total, window)
    return [window] * full + [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]


def pack_ids(docs: Iterator[tuple[object, bytes]], window: int) -> Iterator[tuple[list, int]]:
    """Finished windows as ``(pieces, ids)``; a piece is ``(doc, start, packed ids, doc ids)``."""
    packer = SumOfSquares(window)
    for doc, packed in docs:
        n = len(packed) // 4
        whole = n // window * window
        for at in range(0, whole, window):
            yield [(doc, at, packed[4 * at:4 * (at + window)], n)], window
        if n > whole:
            win = packer.place(n - whole)
            win.append((doc, whole, packed[4 * whole:], n))
            if sum(len(p[2]) for p in win) == 4 * window:
                yield win, window
    loose = [p for win in packer.rest() for p in win]
    lengths = _power_cuts(sum(len(p[2]) // 4 for p in loose), window)
    left = iter(loose)
    doc, start, packed, n = next(left, (None, 0, b"", 0))
    for length in lengths:
        win, need = [], length
        while need:
            if not packed:
                doc, start, packed, n = next(left)
            take = min(need, len(packed) // 4)
            win.append((doc, start, packed[:4 * take], n))
            start, packed, need = start + take, packed[4 * take:], need - take
        yield win, length


def pack_documents(df: DataFrame, rank_file: str, pattern: str, end_id: int = 0, window: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``(id, start, length, doc_tokens, sequence_id, offset, token_bytes)``.

    ``token_bytes`` holds the piece's ids as little-endian unsigned 32-bit
    numbers. ``sequence_id`` is the scan partition and a running number.
    """
    ship(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding("documents", pat_str=pattern, mergeable_ranks=ranks.value,
                                  special_tokens={})
        cache = TokenCache(Pretokens(pattern), lambda tokens: [
            array("i", coder.encode_ordinary(t)).tobytes() for t in tokens])
        end = np.array([end_id], "<u4").tobytes()

        def docs():
            for part, texts in slices(batches, text_col):
                yield from zip(part.column(id_col).to_pylist(),
                               (p + end for p in cache.encode([t or "" for t in texts])))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

        first = TaskContext.get().partitionId() << 40
        rows, held = [], 0
        for seq, (win, length) in enumerate(pack_ids(docs(), window)):
            at = 0
            for doc, start, packed, n in win:
                rows.append((doc, start, len(packed) // 4, n, first + seq, at, packed))
                at += len(packed) // 4
            held += length
            if held > 500_000:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    id_type = df.schema[id_col].dataType
    out = pa.schema([(id_col, to_arrow_type(id_type)), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("token_bytes", pa.binary())])
    return df.select(id_col, text_col).mapInArrow(
        run, f"{id_col} {id_type.simpleString()}, start long, length long, doc_tokens long,"
             " sequence_id long, offset long, token_bytes binary")
