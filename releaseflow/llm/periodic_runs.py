"""Periodic runs of words (operator 11), by string synchronising sets.

A run is a stretch of words with smallest period q, of length at least
``max(6, 4 * q)``, that no neighbouring word extends keeping that period.

For each scale s = 4, 8, 16 .. a position is selected if, among the hashes of the
s-word windows that begin within the next s words, the least is the first or the
last; windows with a period of s / 3 or less don't count. Selection depends on the
next 2 s words only, so equal contexts are selected alike, and every stretch of
3 s - 1 words without such a small period begins within s words of a selected
position. A run of period q, s <= q < 2 s, therefore holds two selected positions
at distance q with equal 2 s-word contexts, one the next of its kind after the
other: such neighbours propose their distance as a period. Proposals are compared
word by word and extended to the whole run, so hashes decide nothing.

The sets leave out highly periodic regions. Periods up to 5 are found apart, by
comparing the text with itself shifted; the regions of a period p in
(s / 6, s / 3] that scale s must leave out come from the pairs of scale s / 8, which
meet every such region of s words or more.

Each text is worked on by itself, in one pass without a shuffle; work is about
linear in its words for each scale, and scale s takes only texts of 4 s words or
more. Null and empty texts have no words and no runs. Repeated rows give repeated
results, an empty table an empty one. Other columns pass through, apart from those
named like the result. Very long texts are held whole by their task, at some 150
bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from releaseflow.llm.ship import ship
from releaseflow.llm.tokens import Tokens, parts, schema_with
from releaseflow.llm.windows import mix

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Periods found by shifting; the scales begin above.
SHIFTED = 5
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _next_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows twice as long."""
    return mix(h[:len(h) - size] * _A + h[size:] * _B) if len(h) > size else h[:0]


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal stretch of true values of ``least`` or more."""
    edge = np.diff(same.astype(np.int8), prepend=0, append=0)
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = b - a >= least
    return a[long], b[long]


def _window_least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` consecutive values."""
    n = len(x) - size + 1
    pad = -len(x) % size
    rows = np.append(x, np.full(pad, _NONE)).reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[size - 1:size - 1 + n])


def synchronising_set(hashes: np.ndarray, size: int, regions: list[tuple[int, int, int]]) -> np.ndarray:
    """Selected positions, given the hashes of all windows of ``size`` words and the periodic regions."""
    own = hashes.copy()
    for a, b, p in regions:
        if 3 * p <= size <= b - a:
            own[a:b - size + 1] = _NONE
    if len(own) <= size:
        return np.zeros(0, np.int64)
    least = _window_least(own, size + 1)
    n = len(least)
    return np.flatnonzero((least != _NONE) & ((least == own[:n]) | (least == own[size:size + n])))


def _whole(seq: np.ndarray, a: int, b: int, p: int) -> list[tuple[int, int, int]]:
    """Maximal stretches of period ``p`` that meet [a, b), of three periods or more."""
    step, lo, hi = 64 + 2 * p, a, b - p  # seq[lo:hi] is compared with seq[lo + p:hi + p]
    while lo > 0:
        at = max(0, lo - step)
        differ = np.flatnonzero(seq[at:lo] != seq[at + p:lo + p])
        if len(differ):
            lo = at + int(differ[-1]) + 1
            break
        lo, step = at, 2 * step
    step, end = 64 + 2 * p, len(seq) - p
    while hi < end:
        to = min(end, hi + step)
        differ = np.flatnonzero(seq[hi:to] != seq[hi + p:to + p])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = to, 2 * step
    begin, stop = _stretches(seq[lo:hi] == seq[lo + p:hi + p], 2 * p)
    return [(lo + int(x), lo + int(y) + p, p) for x, y in zip(begin, stop)]


def _proposals(at: np.ndarray, context: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
    """Stretches that pairs of equal neighbouring contexts cover, pairs of one stretch together."""
    order = np.argsort(context, kind="stable")
    same = np.flatnonzero(context[order[1:]] == context[order[:-1]])
    s, gap = at[order[same]], at[order[same + 1]] - at[order[same]]
    near = gap <= 8 * size // 3
    s, gap = s[near], gap[near]
    order = np.lexsort((s, gap))
    s, gap = s[order], gap[order]
    new = np.ones(len(s), bool)
    new[1:] = (gap[1:] != gap[:-1]) | (np.diff(s) > 2 * size)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s))[:len(first)] - 1
    yield from zip(s[first].tolist(), (s[last] + gap[first] + 2 * size).tolist(), gap[first].tolist())


def periodic_regions(seq: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """``(begin, end, smallest period)`` of all runs of four periods or more, and of some of three.

    ``seq`` holds texts from the longest to the shortest, each followed by a number
    found nowhere else; ``ends`` are the positions of these numbers.
    """
    found: dict[tuple[int, int], int] = {}

    def keep(regions: list[tuple[int, int, int]]) -> None:
        for a, b, p in regions:
            found[a, b] = min(p, found.get((a, b), p))

    for p in range(1, SHIFTED + 1):
        a, b = _stretches(seq[:-p] == seq[p:], 2 * p)
        keep([(x, y + p, p) for x, y in zip(a.tolist(), b.tolist())])
    length = np.diff(ends, prepend=-1) - 1
    h, size = mix((seq.astype(np.uint64) + np.uint64(1)) * _A), 1
    while True:
        texts = int(np.searchsorted(-length, -LEAST_PERIODS * size, side="right"))
        if not texts:
            break
        h = h[:max(0, int(ends[texts - 1]) + 1 - size + 1)]
        wide = _next_hash(h, size)
        if size >= 4:
            regions = [(a, b, p) for (a, b), p in found.items() if a < len(h)]
            at = synchronising_set(h, size, regions)
            at = at[at < len(wide)]
            for a, b, p in _proposals(at, wide[at], size):
                keep(_whole(seq, a, b, p))
        h, size = wide, 2 * size
    return [(a, b, p) for (a, b), p in found.items()]


def find_runs(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of all runs, by text, start and period."""
    size = np.diff(tokens.start)
    order = np.argsort(-size, kind="stable")
    ends = np.cumsum(size[order] + 1) - 1
    seq = np.empty(int(size.sum()) + len(size), np.int64)
    place = np.empty(len(size), np.int64)  # of each text in ``seq``
    place[order] = ends - size[order]
    seq[np.arange(len(tokens.ids)) + np.repeat(place - tokens.start[:-1], size)] = tokens.ids
    seq[ends] = len(tokens.words) + np.arange(len(size))
    regions = periodic_regions(seq, ends) if len(size) else []
    a, b, p = np.array(regions, np.int64).reshape(-1, 3).T
    real = b - a >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
    a, b, p = a[real], b[real], p[real]
    text = order[np.searchsorted(ends, a)] if len(a) else a
    by = np.lexsort((p, a, text))
    text, a, b, p = text[by], a[by], b[by], p[by]
    return text, a - place[text], b - a, p


def _collapsed(tokens: Tokens, text: np.ndarray, start: np.ndarray, length: np.ndarray,
               period: np.ndarray) -> pa.Array:
    """Words of each text without those after the first period of a run."""
    cover = np.zeros(len(tokens.ids) + 1, np.int64)
    begin = tokens.start[text] + start
    np.add.at(cover, begin + period, 1)
    np.add.at(cover, begin + length, -1)
    stays = np.cumsum(cover[:-1]) == 0
    ends = np.append(0, np.cumsum(stays))[tokens.start]
    kept = tokens.flat.filter(pa.array(stays))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), kept), " ")


def collapse_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns of ``df`` and ``n_words``, ``runs`` (start, length, period), ``strongest``, ``collapsed``.

    Runs are in order of start, then period. ``strongest`` is the run of greatest
    length by period (ties: smallest start, then period), null without a run.
    ``collapsed`` is the text without the words that a run repeats, joined by blanks.
    """
    ship(df.sparkSession)
    added = ("n_words", "runs", "strongest", "collapsed")
    df = df.select([c for c in df.columns if c not in added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, text_col):
            tokens = Tokens.of(part.column(text_col))
            text, start, length, period = found = find_runs(tokens)
            runs = pa.StructArray.from_arrays([pa.array(x) for x in found[1:]], fields=list(_RUN))
            edge = np.searchsorted(text, np.arange(part.num_rows + 1))
            best = []
            for a, b in zip(edge.tolist(), edge[1:].tolist()):
                top = a
                for k in range(a + 1, b):
                    if int(length[k]) * int(period[top]) > int(length[top]) * int(period[k]):
                        top = k
                best.append(top if b > a else None)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(tokens.start)),
                 pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), runs),
                 runs.take(pa.array(best, pa.int64())), _collapsed(tokens, *found)],
                names=[*part.schema.names, *added])

    run = "struct<start: bigint, length: bigint, period: bigint>"
    return df.mapInArrow(work, schema_with(df.schema.fields, f"n_words bigint, runs array<{run}>, "
                                                             f"strongest {run}, collapsed string"))
