"""Language identification (operator 9).

A text is the average of hashed subword embeddings (character 1- to 4-grams of
the lower-cased text, blanks included) under a linear softmax, as in fastText,
trained by stochastic gradient descent in numpy on the driver. Training rows are
a bounded sample: about ``PER_LABEL`` documents of each language (fewer beyond
``FULL_LABELS`` languages, ``LEAST_PER_LABEL`` at least), chosen by a hash of id and text,
each giving up to ``SEGMENTS`` stretches of at most ``SEGMENT_CHARS`` characters. A fifth of the sample is kept
for calibration: a temperature for the scores and the rejection limit.

Prediction reads whole texts. Null texts and texts without a letter are ``und``
with score 0 and are rejected. Rows are independent: repeated rows give repeated
results; an empty table, or one without labelled rows, predicts ``und`` only.
Columns beside id, text and label are ignored; language, source and id are never
inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.llm.ship import ship
from releaseflow.llm.vocab import slices

PER_LABEL, FULL_LABELS, LEAST_PER_LABEL = 1500, 128, 50
SEGMENTS, SEGMENT_CHARS = 2, 400
BUCKETS, DIM, ORDERS = 1 << 14, 16, 4
#: Largest share of right answers on the calibration rows that rejection may cost.
REJECT_SHARE = 0.0005
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20


def _grams(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of the character n-grams of the whole text, chunk by chunk."""
    text = f" {text.lower()} "
    for at in range(0, len(text), _CHUNK):
        piece = text[at:at + _CHUNK + ORDERS - 1]
        cp = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        own = min(_CHUNK, len(cp))
        h = np.zeros(len(cp), np.uint32)
        for n in range(ORDERS):
            h = (h[:len(cp) - n] * np.uint32(0x01000193)) ^ (cp[n:] + np.uint32(n + 1)) * np.uint32(0x9E3779B1)
            yield ((h[:own] ^ (h[:own] >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(18)).astype(
                np.int64) % buckets


@dataclass
class LanguageModel:
    """Embeddings folded into the softmax: one weight row per bucket."""

    labels: list[str]
    weights: np.ndarray  # buckets x labels
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    buckets: int = field(default=BUCKETS)

    def logits(self, text: str) -> np.ndarray:
        count = np.zeros(self.buckets)
        for grams in _grams(text, self.buckets):
            count += np.bincount(grams, minlength=self.buckets)
        return count @ self.weights / count.sum() + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``."""
        if not text or not self.labels or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        score = float(p[best] / p.sum())
        return self.labels[best], score, score < self.reject_below


def learnable(id_col: str = "doc_id") -> Column:
    """Rows the model may learn from: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1


def training_sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "lang") -> list[tuple[str, str]]:
    """At most about ``PER_LABEL * SEGMENTS`` stretches of text for each label, of every label some."""
    rows = df.filter(learnable(id_col) & F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = rows.groupBy(label_col).count().orderBy(F.desc("count"), label_col).collect()
    if not counts:
        return []
    share = min(PER_LABEL, max(LEAST_PER_LABEL, PER_LABEL * FULL_LABELS // len(counts)))
    rate = F.create_map(*(F.lit(x) for r in counts for x in (r[0], min(1.0, share / r[1]))))
    draw = F.pmod(F.xxhash64(id_col, text_col, F.lit(1)), F.lit(1 << 30)) / F.lit(1 << 30)
    size = F.length(text_col)
    at = [F.pmod(F.xxhash64(id_col, F.lit(k + 2)), F.greatest(size - SEGMENT_CHARS + 1, F.lit(1)))
          for k in range(SEGMENTS)]
    texts = F.array_distinct(F.array(*(F.substring(text_col, a.cast("int") + 1, F.lit(SEGMENT_CHARS)) for a in at)))
    # Rows are drawn each by itself and equal stretches kept once, so repeated rows can't crowd out others.
    return [(r[0], r[1]) for r in rows.filter(draw < rate[F.col(label_col)])
            .select(label_col, F.explode(texts).alias("piece")).distinct().collect() if _LETTER.search(r[1])]


def train(sample: list[tuple[str, str]], epochs: int = 4, rate: float = 4.0, seed: int = 3) -> LanguageModel:
    """Stochastic gradient descent over averaged embeddings, then calibration."""
    sample = sorted(sample)
    labels = sorted({lab for lab, _ in sample})
    if not labels:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    want = np.array([labels.index(lab) for lab, _ in sample])
    order = rng.permutation(len(sample))
    held, fit = order[:len(order) // 5], order[len(order) // 5:]
    # A label whose stretches were all kept back would not be learnt.
    missed = np.isin(want[held], want[fit], invert=True)
    held, fit = held[~missed], np.append(fit, held[missed])
    if not len(held):
        held = fit
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, len(labels))), np.zeros(len(labels))
    steps = epochs * len(fit)
    for step in range(steps):
        k = fit[rng.integers(len(fit))]
        pace = rate * (1 - step / steps)
        grams = np.concatenate(list(_grams(sample[k][1], BUCKETS)))  # anew each time: the driver keeps the texts only
        mean = emb[grams].mean(axis=0)
        z = mean @ out + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[want[k]] -= 1
        back = out @ p
        out -= pace * np.outer(mean, p)
        bias -= 0.1 * pace * p
        ids, n = np.unique(grams, return_counts=True)
        emb[ids] -= (pace * n / len(grams))[:, None] * back
    model = LanguageModel(labels, emb @ out, bias)
    return _calibrate(model, [sample[k][1] for k in held], want[held])


def _calibrate(model: LanguageModel, texts: list[str], want: np.ndarray) -> LanguageModel:
    """Temperature of least log loss; the limit that costs ``REJECT_SHARE`` of the right answers."""
    z = np.array([model.logits(t) for t in texts])

    def scores(temp: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / temp)
        return p / p.sum(axis=1, keepdims=True)

    rows = np.arange(len(want))
    model.temperature = min(np.geomspace(0.05, 20, 60),
                            key=lambda t: -np.log(scores(t)[rows, want] + 1e-12).mean())
    p = scores(model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == want]
    if len(right):
        model.reject_below = float(min(0.4, np.quantile(right, REJECT_SHARE)))
    return model


def fit_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "lang") -> LanguageModel:
    return train(training_sample(df, id_col, text_col, label_col))


def predict_languages(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and ``lang_pred``, ``score``, ``rejected``."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("lang_pred", "score", "rejected")]
    df = df.select(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for part, texts in slices(batches, text_col):
            lang, score, rejected = zip(*map(lm.predict, texts))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=[*part.schema.names, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")
