"""Toxicity of texts (operator 13): a factorization machine over hashed terms.

A text is the set of hash buckets of its lower-cased terms and of the first
``STEM`` characters of longer terms, each bucket weighing the root of its share of
the text's terms, so long and short texts are alike. In training, buckets weigh the
more the further their shares of toxic and other texts lie apart beyond chance; the
factor is folded into what is learnt. Besides a weight, each bucket has a vector of ``FACTORS`` numbers; the product of two vectors is what the two
buckets add together. An insult that counts only next to the mention of a group is
learnt that way, which a sum of weights misses.

The machine is fitted by stochastic gradient descent (AdaGrad) in numpy on the
driver, on a bounded sample of labelled rows: about ``PER_LABEL`` ids of each label,
drawn by a hash of the id, one text of each id (the one of least hash), at most
``SAMPLE_TERMS`` terms of it from a place that the id's hash gives. Rows count by the
inverse of their label's rate of drawing, so scores keep the table's share of toxic
rows. A fifth of the sample is kept back; on it the scores are calibrated.

Scoring reads whole texts, in one pass without a shuffle; the model (9 MB) is
broadcast. Null and empty texts have no terms and get the score of the calibrated
bias. Rows with null labels or ids are not learnt from; of several labels of an id the
greatest counts. Without labelled rows every score is 0; with one label only it is
that label's share, a little drawn to the middle. Repeated rows give repeated
results, an empty table an empty one. Ties can't change a result: each row is scored
alone. Columns beside id, text and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.llm.ship import ship
from releaseflow.llm.tokens import TERM_BYTES, Tokens, parts, schema_with

PER_LABEL, SAMPLE_TERMS = 6000, 4000
BUCKETS, FACTORS, STEM = 1 << 18, 8, 5
EPOCHS, RATE, BATCH, DECAY = 12, 0.3, 64, 2e-4
#: Buckets of fewer sample texts keep a weight of 0: they could only learn single texts by heart.
LEAST_TEXTS = 3
#: A bucket weighs ``GAIN`` times (``GAIN_FLOOR`` + log ratio of its shares, in full from ``SURE`` standard errors on).
GAIN, GAIN_FLOOR, SURE = 3.0, 0.2, 4.0


@dataclass
class Features:
    """Buckets and their weights of several texts, one after the other."""

    bucket: np.ndarray
    x: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, tokens: Tokens) -> Features:
        n = len(tokens.start) - 1
        many = len(tokens.words)
        pair, tf = np.unique(tokens.owner() * max(1, many) + tokens.ids, return_counts=True)
        doc, word = pair // max(1, many), pair % max(1, many)
        whole = _buckets(tokens.words, 1)
        stems = np.where(pc.greater(pc.utf8_length(tokens.words), STEM).to_numpy(zero_copy_only=False),
                         _buckets(pc.utf8_slice_codeunits(tokens.words, 0, STEM), 2), -1)
        stem = stems[word] >= 0
        key = np.concatenate([doc * BUCKETS + whole[word], doc[stem] * BUCKETS + stems[word[stem]]])
        key, where = np.unique(key, return_inverse=True)
        share = np.bincount(where, np.concatenate([tf, tf[stem]]), minlength=len(key))
        doc = key // BUCKETS
        size = np.diff(tokens.start)
        return cls((key % BUCKETS).astype(np.int32), np.sqrt(share / size[doc]).astype(np.float32),
                   np.searchsorted(doc, np.arange(n + 1)))

    def take(self, rows: np.ndarray) -> Features:
        size = np.diff(self.start)[rows]
        start = np.append(0, np.cumsum(size))
        at = np.arange(start[-1]) + np.repeat(self.start[rows] - start[:-1], size)
        return Features(self.bucket[at], self.x[at], start)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of the values of each text."""
        some = np.flatnonzero(np.diff(self.start))
        out = np.zeros((len(self.start) - 1, *values.shape[1:]))
        if len(some):
            out[some] = np.add.reduceat(values, self.start[some], axis=0)
        return out


def _buckets(words: pa.Array, kind: int) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.int64)
    hashes = pd.util.hash_array(words.to_numpy(zero_copy_only=False), hash_key=f"releaseflow-{kind:04d}",
                                categorize=False)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class FactorizationMachine:
    weight: np.ndarray
    factor: np.ndarray
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, f: Features) -> np.ndarray:
        """Bias, weights and pairwise products of each text."""
        v = self.factor[f.bucket] * f.x[:, None]
        return (self.bias + f.sums(self.weight[f.bucket] * f.x)
                + 0.5 * ((f.sums(v) ** 2).sum(axis=1) - f.sums((v ** 2).sum(axis=1))))

    def score(self, f: Features) -> np.ndarray:
        return _sigmoid(self.scale * self.raw(f) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-z))


def _constant(share: float) -> FactorizationMachine:
    shift = -1000.0 if share <= 0 else float(np.log(share / (1 - share)))
    return FactorizationMachine(np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32), shift=shift)


def _gains(f: Features, toxic: np.ndarray, importance: np.ndarray) -> np.ndarray:
    """How much each bucket weighs in training."""
    row = np.repeat(np.arange(len(toxic)), np.diff(f.start))
    n = np.array([(importance * (1 - toxic)).sum(), (importance * toxic).sum()])
    with_it = np.array([np.bincount(f.bucket, (importance * (toxic == y))[row], minlength=BUCKETS) for y in (0, 1)])
    ratio = np.abs(np.diff(np.log((with_it + 1) / (n[:, None] + 2)), axis=0)[0])
    share = with_it.sum(axis=0) / n.sum()
    error = np.sqrt(share * (1 - share) * (1 / n).sum()) + 1e-9
    apart = np.abs(np.diff(with_it / n[:, None], axis=0)[0]) / error
    return GAIN * (GAIN_FLOOR + ratio * np.minimum(1, (apart / SURE) ** 2))


def train(f: Features, toxic: np.ndarray, importance: np.ndarray, seed: int = 7) -> FactorizationMachine:
    """Fit on four fifths of the texts, calibrate on the rest."""
    n = len(toxic)
    if not n:
        return _constant(0.0)
    if toxic.all() or not toxic.any():
        return _constant((toxic.sum() + 0.5) / (n + 1))
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    fit, held = order[n // 5:], order[:n // 5]
    if len(set(toxic[fit])) < 2 or len(set(toxic[held])) < 2:
        fit = held = order
    importance = importance / importance.mean()
    texts = np.bincount(f.take(fit).bucket, minlength=BUCKETS)
    real = texts >= LEAST_TEXTS
    own = np.cumsum(real) - 1
    keep = real[f.bucket]
    gain = _gains(f.take(fit), toxic[fit], importance[fit])
    small = Features(own[f.bucket[keep]], (f.x * gain[f.bucket])[keep], np.append(0, np.cumsum(f.sums(keep.astype(np.int64))))
                     .astype(np.int64))
    m = int(real.sum())
    p = float((importance * toxic)[fit].sum() / importance[fit].sum())
    w, v = np.zeros(m), rng.normal(0, 0.05, (m, FACTORS))
    bias, gw, gv, gb = float(np.log(p / (1 - p))), np.full(m, 1e-6), np.full((m, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        mixed = rng.permutation(fit)
        for a in range(0, len(mixed), BATCH):
            rows = mixed[a:a + BATCH]
            b = small.take(rows)
            ids, at = np.unique(b.bucket, return_inverse=True)
            x = b.x[:, None].astype(np.float64)
            vx = v[b.bucket] * x
            total = b.sums(vx)
            z = bias + b.sums(w[b.bucket] * x[:, 0]) + 0.5 * ((total ** 2).sum(axis=1) - b.sums((vx ** 2).sum(axis=1)))
            g = (_sigmoid(z) - toxic[rows]) * importance[rows]
            g_each = np.repeat(g, np.diff(b.start))
            dw = np.bincount(at, g_each * x[:, 0], minlength=len(ids)) / len(rows) + DECAY * w[ids]
            each = g_each[:, None] * x * (np.repeat(total, np.diff(b.start), axis=0) - vx)
            dv = np.stack([np.bincount(at, each[:, k], minlength=len(ids)) for k in range(FACTORS)], axis=1)
            dv = dv / len(rows) + DECAY * v[ids]
            gw[ids] += dw ** 2
            gv[ids] += dv ** 2
            gb += g.mean() ** 2
            w[ids] -= RATE * dw / np.sqrt(gw[ids])
            v[ids] -= 0.3 * RATE * dv / np.sqrt(gv[ids])
            bias -= RATE * 0.3 * g.mean() / np.sqrt(gb)
    model = _constant(0.5)
    model.weight[real], model.factor[real] = w * gain[real], v * gain[real][:, None]
    model.bias = float(bias)
    return _calibrated(model, f.take(held), toxic[held], importance[held])


def _calibrated(model: FactorizationMachine, f: Features, toxic: np.ndarray,
                importance: np.ndarray) -> FactorizationMachine:
    """Scale and shift of least log loss on the texts, by Newton steps."""
    z = model.raw(f)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(theta[0] * z + theta[1])
        basis = np.stack([z, np.ones_like(z)])
        grad = basis @ (importance * (p - toxic)) + 1e-2 * (theta - [1.0, 0.0])
        hess = (basis * (importance * p * (1 - p))) @ basis.T + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    if theta[0] > 0:
        model.scale, model.shift = map(float, theta)
    return model


def learnable(id_col: str = "doc_id") -> Column:
    """Ids the model may learn from: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> tuple[Features, np.ndarray, np.ndarray]:
    """Features, labels (0 or 1) and importance of about ``PER_LABEL`` texts of each label."""
    ship(docs.sparkSession)
    marked = (labels.filter(F.col(label_col).isNotNull() & learnable(id_col))
              .groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y")))
    count = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    rate = {y: min(1.0, PER_LABEL / count[y]) for y in count}
    draw = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = marked.filter(draw < F.when(F.col("y") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0)))
    # At most some 2 * PER_LABEL ids, drawn independently.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter(learnable("id"))
    texts = (texts.join(F.broadcast(drawn), "id")
             .groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t")))
    rows = texts.mapInArrow(_packed, "id long, y int, bucket binary, x binary").collect()
    rows.sort(key=lambda r: r["id"])
    y = np.array([r["y"] for r in rows], np.int64)
    size = [len(r["bucket"]) // 4 for r in rows]
    f = Features(np.frombuffer(b"".join(r["bucket"] for r in rows), "<i4"),
                 np.frombuffer(b"".join(r["x"] for r in rows), "<f4"), np.append(0, np.cumsum(size)).astype(np.int64))
    return f, y, np.array([1 / rate[k] for k in y.tolist()])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of one stretch of ``SAMPLE_TERMS`` terms of each text."""
    for part in parts(batches, "t"):
        tokens = Tokens.of(part.column("t"), TERM_BYTES)
        size = np.diff(tokens.start)
        place = pd.util.hash_array(part.column("id").to_numpy(zero_copy_only=False)) % np.maximum(
            1, size - SAMPLE_TERMS + 1).astype(np.uint64)
        at = np.arange(len(tokens.ids)) - np.repeat(tokens.start[:-1] + place.astype(np.int64), size)
        own = (at >= 0) & (at < SAMPLE_TERMS)
        kept = np.append(0, np.cumsum(own))[tokens.start]
        f = Features.of(Tokens(tokens.ids[own], kept, tokens.words, tokens.flat))
        cut = list(zip(f.start[:-1].tolist(), f.start[1:].tolist()))
        yield pa.RecordBatch.from_arrays(
            [part.column("id").cast(pa.int64()), part.column("y").cast(pa.int32()),
             pa.array([f.bucket[a:b].tobytes() for a, b in cut], pa.binary()),
             pa.array([f.x[a:b].tobytes() for a, b in cut], pa.binary())], names=["id", "y", "bucket", "x"])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> FactorizationMachine:
    return train(*training_sample(docs, labels, id_col, text_col, label_col))


def score_toxicity(df: DataFrame, model: FactorizationMachine, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and ``score``, ``predicted``."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    df = df.select([c for c in df.columns if c not in ("score", "predicted")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, text_col, 2 << 20):
            score = shared.value.score(Features.of(Tokens.of(part.column(text_col), TERM_BYTES)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             names=[*part.schema.names, "score", "predicted"])

    return df.mapInArrow(work, schema_with(df.schema.fields, "score double, predicted int"))
