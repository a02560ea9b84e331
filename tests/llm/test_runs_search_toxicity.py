"""Periodic runs, ranked search and toxicity against brute force, with awkward rows."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from releaseflow.llm import lexical_search, periodic_runs, queries, toxicity
from releaseflow.llm.tokens import TERM_BYTES, Tokens

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, item long, rank int, runs string, score string, n_words string"


def table(spark, texts, start=0):
    """Documents with columns named like the operators' results."""
    return spark.createDataFrame([(start + i, t, 1, 2, "r", "s", "w") for i, t in enumerate(texts)], CLASHING)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def terms_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


# -- words ---------------------------------------------------------------------------------------


def test_tokens_equal_the_patterns():
    rng = random.Random(4)
    chars = "aB9_-é \n\t\x0b\x1c\x7f\x85 #z"
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 30))) for _ in range(500)] + [None, "", " ", "a"]
    for column in (pa.array(texts), pa.array(["pad", *texts])[1:]):
        for table_, expected in ((None, words_of), (TERM_BYTES, terms_of)):
            tokens = Tokens.of(column, table_)
            words = tokens.words.to_pylist()
            got = [[words[k] for k in tokens.ids[a:b]] for a, b in zip(tokens.start, tokens.start[1:])]
            assert got == [expected(t) for t in texts]


# -- 11 ------------------------------------------------------------------------------------------


def all_runs(words):
    """Every run by definition: maximal stretches of each period, the smallest period of each stretch."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        k = 0
        while k < len(words) - q:
            a = k
            while k < len(words) - q and words[k] == words[k + q]:
                k += 1
            if k > a and k - a + q >= max(6, 4 * q):
                found.setdefault((a, k - a + q), q)
            k += 1
    return sorted((a, n, q) for (a, n), q in found.items())


def periodic_texts(seed, n):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        letters, out = rng.choice([1, 2, 3, 5, 60]), []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                unit = [f"w{rng.randrange(letters)}" for _ in range(rng.choice([*range(1, 14), 16, 21, 31, 32, 33, 70]))]
                if rng.random() < 0.3:
                    unit = unit * rng.randint(2, 7)
                size = len(unit) * rng.choice([2, 3, 4, 4, 5, 9]) + rng.randrange(len(unit) + 1) - len(unit) // 2
                out += (unit * 12)[:size]
            else:
                out += [f"w{rng.randrange(letters)}" for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(out))
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    texts = [*periodic_texts(seed, 120), None, "", " \n", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b"]
    text, start, length, period = periodic_runs.find_runs(Tokens.of(pa.array(texts, pa.string())))
    got = {}
    for k, *run in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got.setdefault(k, []).append(tuple(run))
    for k, t in enumerate(texts):
        assert got.get(k, []) == all_runs(words_of(t)), k


def test_a_synchronising_set_is_consistent_and_dense():
    rng = random.Random(2)
    words = [rng.randrange(3) for _ in range(3000)]
    words[1000:1400] = [0, 1] * 200
    words[2000:2200] = words[300:500]
    seq, size = np.array(words), 16
    h = periodic_runs.mix(seq.astype(np.uint64) + np.uint64(1))
    for k in (1, 2, 4, 8):
        h = periodic_runs._next_hash(h, k)
    regions = periodic_runs.periodic_regions(np.append(seq, 9), np.array([len(seq)]))
    at = set(periodic_runs.synchronising_set(h, size, regions).tolist())
    for i in range(300, 500 - 2 * size):
        assert (i in at) == (i + 1700 in at)

    def period(w):
        return next(p for p in range(1, len(w) + 1) if all(w[k] == w[k + p] for k in range(len(w) - p)))

    for i in range(len(words) - 4 * size):
        dense = any(k in at for k in range(i, i + size))
        assert dense == (period(words[i:i + 3 * size - 1]) > size // 3)


def test_long_runs_and_a_long_text_without_any():
    rng = random.Random(8)
    unit = [str(rng.randrange(10 ** 9)) for _ in range(30_000)]
    one = " ".join(["a"] * 300_000)
    many = " ".join(unit * 4 + ["end"])
    none = " ".join(str(rng.randrange(10 ** 9)) for _ in range(200_000))
    got = periodic_runs.find_runs(Tokens.of(pa.array([none, one, many])))
    assert list(zip(*(x.tolist() for x in got))) == [(1, 0, 300_000, 1), (2, 0, 120_000, 30_000)]


def test_collapsing_keeps_the_first_period(spark):
    texts = ["x " + "a b " * 5 + "c " + "d " * 7, "no runs  here", None, "", "a b " * 4]
    rows = periodic_runs.collapse_runs(table(spark, [*texts, texts[0]])).orderBy("doc_id").collect()
    assert [r["collapsed"] for r in rows] == ["x a b c d", "no runs here", "", "", "a b", "x a b c d"]
    assert [r["n_words"] for r in rows] == [19, 3, 0, 0, 8, 19]
    assert [[tuple(x) for x in r["runs"]] for r in rows][0] == [(1, 10, 2), (12, 7, 1)]
    assert tuple(rows[0]["strongest"]) == (12, 7, 1) and rows[1]["strongest"] is None
    assert rows[0]["item"] == 1 and rows[0]["score"] == "s"
    assert periodic_runs.collapse_runs(table(spark, [])).count() == 0


def test_runs_query_equals_the_contract(spark):
    import hashlib
    import pandas as pd
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs) == len(pd.read_parquet(f"{SF}/documents.parquet"))
    for doc_id, text in docs.items():
        w = words_of(text)
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = all_runs(w)
        gone = {i for a, m, q in runs for i in range(a + q, a + m)}
        best = max(runs, key=lambda r: (math.inf if r[2] == 0 else r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


# -- 12 ------------------------------------------------------------------------------------------


def ranked(docs, items, k):
    """``[(item, rank, doc, score)]`` by the formula."""
    texts = [(d, terms_of(t)) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    n, total = len(texts), sum(len(t) for _, t in texts)
    out = []
    for item, text in set(items):
        scores = []
        for d, t in texts:
            m, s = 75 + 25 * len(t) * n // total, 0
            for term in terms_of(text):
                df, tf = sum(term in x for _, x in texts), t.count(term)
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10 ** 9 * tf // (1000 * tf + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def search_corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 20, 60]))) for _ in range(n)]
    texts += texts[:n // 4]  # copies: equal scores
    docs = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[1]), (None, texts[2]), (3, None), (4, "#!")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(12)]
    return docs, [*items, items[0], (50, None), (51, ""), (52, "Unknown!"), (53, "T1,t1;T2")]


@pytest.mark.parametrize("seed,k", [(0, 20), (1, 3), (2, 1)])
def test_search_equals_the_formula(spark, seed, k, monkeypatch):
    docs, items = search_corpus(seed, 150)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1))
    expected = ranked(docs, items, k)
    assert sorted(map(tuple, lexical_search.search_documents(d, i, k).collect()), key=str) == expected
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 300)  # several blocks of items
    assert sorted(map(tuple, lexical_search.search_documents(d, i, k).collect()), key=str) == expected


def test_search_over_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("false"), items.filter("false"))):
        out = lexical_search.search_documents(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_tree_cells_hold_maxima_and_many_blocks_agree():
    rng = np.random.default_rng(5)
    dense = (rng.random((90, 40)) < 0.2) * rng.integers(1, 10 ** 6, (90, 40))
    row, col = np.nonzero(dense)
    tree = lexical_search.Treap(row, col, dense[row, col])
    for size in (1, 4, 16):
        cells = tree.paths(np.arange(90), size, -(-40 // size))
        for r in range(90):
            for c in range(cells.shape[1]):
                block = dense[r // size * size:(r // size + 1) * size, c * size:(c + 1) * size]
                assert tree.best[cells[r, c]] == block.max()


def test_a_very_long_document(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(400_000))
    docs, items = [(1, long), (2, "w1 w2"), (3, "w1")], [(1, "w1 W2")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical_search.search_documents(d, i, 20).collect()), key=str) == ranked(docs, items, 20)


# -- 13 ------------------------------------------------------------------------------------------


def features(texts):
    return toxicity.Features.of(Tokens.of(pa.array(texts, pa.string()), TERM_BYTES))


def test_factorization_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = toxicity.FactorizationMachine(rng.normal(size=toxicity.BUCKETS), rng.normal(
        size=(toxicity.BUCKETS, toxicity.FACTORS)), 0.3)
    texts = ["one two three three", None, "", "longerword one", "x"]
    f = features(texts)
    for k, z in enumerate(model.raw(f)):
        own = range(f.start[k], f.start[k + 1])
        b, x = f.bucket, f.x
        plain = 0.3 + sum(model.weight[b[i]] * x[i] for i in own) + sum(
            float(model.factor[b[i]] @ model.factor[b[j]]) * x[i] * x[j] for i in own for j in own if i < j)
        assert z == pytest.approx(plain, rel=1e-5)
    assert f.start.tolist()[1:4] == [3, 3, 3]  # null and empty texts have no terms


def test_pairs_are_learnt_that_weights_miss():
    rng = random.Random(3)
    noise = [f"n{k}" for k in range(40)]

    def text(*extra):
        w = [rng.choice(noise) for _ in range(12)] + list(extra)
        rng.shuffle(w)
        return " ".join(w)

    kinds = [(), ("grim",), ("folk",), ("grim", "folk")]
    rows = [(text(*kinds[k % 4]), int(k % 4 == 3)) for k in range(4000)]
    y = np.array([t for _, t in rows])
    model = toxicity.train(features([t for t, _ in rows[:3000]]), y[:3000], np.ones(3000))
    got = model.score(features([t for t, _ in rows[3000:]]))
    assert ((got >= 0.5) == y[3000:]).mean() > 0.97
    pair = [b for w in ("grim", "folk") for b in features([w]).bucket]
    assert model.factor[pair[0]] @ model.factor[pair[1]] > 0


def test_held_out_toxicity(spark):
    import pandas as pd
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op13_toxicity"](spark, sf).toPandas()
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    both = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet").dropna(subset=["toxic"]), on="doc_id")
    toxic = both.toxic == 1
    assert (both.predicted[toxic] == 1).mean() > 0.9
    assert (both.predicted[~toxic] == 0).mean() > 0.99


def test_toxicity_of_awkward_tables(spark):
    texts = ["you idiot"] * 3 + ["fine day"] * 30 + [None, "", "#", "word " * 200_000]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(33)] + [(0, 0), (None, 1), (5, None), (999, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == len(texts) and rows[0]["item"] == 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", "#")}) == 1
    none = toxicity.fit_toxicity(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    one = toxicity.fit_toxicity(docs, labels.filter("toxic = 0"))
    assert all(r["predicted"] == 0 for r in toxicity.score_toxicity(docs, one).collect())
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0
    assert toxicity.fit_toxicity(docs.limit(0), labels).score(features(["a"]))[0] == 0.0
