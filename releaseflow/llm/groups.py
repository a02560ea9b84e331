"""Walking over the groups of a sorted partition in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Each run of equal ``keys`` as one table.

    The partition must be sorted by ``keys`` and hold whole groups; only one
    group and one batch are in memory at a time. Keys must not be null.
    """
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_tables(held).combine_chunks()


def local_roots(n: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each item's component under the given index pairs."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    lab = rank.copy()
    while True:
        low = np.minimum(lab[left], lab[right])
        new = lab.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = np.minimum(new, new[order[new]])
        if np.array_equal(new, lab):
            return ids[order[lab]]
        lab = new
