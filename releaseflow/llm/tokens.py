"""Whole Arrow columns of texts cut into words, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once; a longer text is worked on alone.
PART_BYTES = 4 << 20

#: Byte table that folds A-Z and turns every other ASCII byte that is no letter or digit into a blank.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def parts(batches: Iterator[pa.RecordBatch], column: str, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of each stay near ``most`` bytes."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        total = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            done = int(total[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


@dataclass
class Tokens:
    """Words of several texts one after the other, as numbers into a list of distinct words."""

    ids: np.ndarray
    start: np.ndarray  # of each text, and the end of the last
    words: pa.Array  # distinct ones
    flat: pa.Array  # all of them

    @classmethod
    def of(cls, texts: pa.Array, table: bytes | None = None) -> Tokens:
        """Runs of bytes other than blank, tab and line breaks (0x09-0x0D), after ``table`` if given.

        Null texts have no words.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if table is not None:
            n, skip = len(texts), texts.offset
            _, ends, data = texts.buffers()
            ends = np.frombuffer(ends, "<i4")[skip:skip + n + 1] if n else np.zeros(1, "<i4")
            blob = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data else b""
            texts = pa.StringArray.from_buffers(n, pa.py_buffer((ends - ends[0]).astype("<i4").tobytes()),
                                                pa.py_buffer(blob.translate(table)))
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
        some = pc.greater(pc.binary_length(flat), 0)
        owner, flat = owner[some.to_numpy(zero_copy_only=False)], flat.filter(some)
        coded = flat.dictionary_encode()
        start = np.searchsorted(owner, np.arange(len(texts) + 1))
        return cls(coded.indices.to_numpy(), start, coded.dictionary, flat)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def schema_with(fields, added: str) -> str:
    """DDL of the fields and of the added columns."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), added])
