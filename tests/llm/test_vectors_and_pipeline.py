"""Vector operators, components, registered queries and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from releaseflow.llm import components, embedding_dedup, langid, topk
from releaseflow.llm.queries import ORACLES, QUERIES
from releaseflow.session import scratch_path
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def vectors(seed=1, n=160, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, dim))
    rows = []
    for k in range(n):
        v = base[k % 12] + rng.standard_normal(dim) * rng.choice([0.02, 0.05, 0.5])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 12 // 6)))
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 0), (n + 1, [0.0] * dim, 0), (n + 2, [nan] * dim, 0), (n + 3, rows[0][1], None),
             (n + 4, [inf] + rows[0][1][1:], 0), (n + 5, [None] + rows[0][1][1:], 0), (n + 6, rows[0][1][:3], 0),
             (n + 7, [], 0), (n + 8, rows[5][1], rows[5][2]), (None, rows[0][1], 0)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows],
                                 "vec_id long, embedding array<float>, label int, key string, n int")


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [512, 4])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    able = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows
            if i is not None and lab is not None and usable(v) and any(v)]
    links, label = {}, {i: i for i, _, _ in rows if i is not None}
    for i, v, lab in able:
        for j, w, other in able:
            if i != j and lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] = links.get(i, 0) + 1
                low, high = sorted((label[i], label[j]))
                label = {k: low if c == high else c for k, c in label.items()}
    got = embedding_dedup.embedding_components(frame(spark, rows + rows[:1])).collect()
    assert len(got) == len(rows) + 1 and sum(links.values()) > 200
    for r in got:
        assert r.n_links == links.get(r.vec_id, 0)
        assert r.component_id == (None if r.vec_id is None else label[r.vec_id])
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)
    assert embedding_dedup.embedding_components(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rows_in_block", [4096, 16])
def test_top_products_equal_brute_force(spark, monkeypatch, rows_in_block):
    monkeypatch.setattr(topk, "ROWS", rows_in_block)
    monkeypatch.setattr(topk, "QUERIES", rows_in_block)
    rows = vectors(2, 300, 48)
    whole = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v, _ in rows
             if i is not None and usable(v)}
    want = set()
    for q, v in whole.items():
        if q % 10 == 0:
            best = sorted((-int(v @ w), c) for c, w in whole.items() if c != q and len(w) == len(v))[:5]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    got = topk.top_products(frame(spark, rows + rows[:1]), F.col("vec_id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_products(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def best_products(whole, asks, k=5):
    """``{(query_id, rank, vec_id, score)}`` by brute force."""
    want = set()
    for q in filter(asks, whole):
        best = sorted((-sum(int(a) * int(b) for a, b in zip(whole[q], w)), c) for c, w in whole.items()
                      if c != q and len(w) == len(whole[q]))[:k]
        want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    return want


def quantised(rows):
    return {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and usable(v)}


def test_top_products_send_k_rows_per_query_and_task(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 16)
    rows, sent, search = vectors(3, 480, 32), spark.sparkContext.accumulator(0), topk._search

    def counted(k):
        def run(batches, inner=search(k)):
            for batch in inner(batches):
                sent.add(batch.num_rows)
                yield batch
        return run

    monkeypatch.setattr(topk, "_search", counted)
    got = topk.top_products(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == best_products(quantised(rows), lambda i: i % 10 == 0)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = sum(i % 10 == 0 for i in quantised(rows))
    assert sent.value <= tasks * 5 * asked < 480 // 16 * 5 * asked


@pytest.mark.parametrize("scale", [1, 1e4, 1e6])
def test_top_products_of_several_groups_of_queries(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "HELD", 2048)
    assert topk._grid(300, 8, 300 * 16, 100 * 16)[1] == 2
    rows = [(i, None if v is None else [None if x is None else x * scale for x in v], lab)
            for i, v, lab in vectors(4, 300, 16)]
    rows += [(1000 + i, rows[i % 3][1], 0) for i in range(40)]  # equal vectors tie
    got = topk.top_products(frame(spark, rows + rows[:50]), F.col("vec_id") % 3 == 0).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == best_products(quantised(rows), lambda i: i % 3 == 0)


def test_top_products_drop_pairs_by_remaining_mass(monkeypatch):
    """Vectors whose mass falls with the dimension, narrow and wide: few pairs need their whole product."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((40, 64)) * 0.8 ** np.arange(64)
    for scale in (40, 1e5, 1e9):
        near = base[rng.integers(0, 40, 1500)] + 0.02 * rng.standard_normal((1500, 64))
        m = np.floor(scale * near).astype(np.int64)
        ids = rng.permutation(1500)
        held = topk._Queries([(ids[:300], np.ascontiguousarray(m[:300].T))], 3)
        heads, few = [], held._few
        monkeypatch.setattr(held, "_few", lambda *a: heads.append(few(*a)) or heads[-1])
        for a in range(0, 1500, 250):
            held.meet(ids[a:a + 250], np.ascontiguousarray(m[a:a + 250].T))
        assert any(h is not None for h in heads) == (scale < 1e9)
        got = {(q, c, s) for b in held.found() for q, c, s in zip(*(x.to_pylist() for x in b.columns))}
        asked = set(ids[:300].tolist())
        want = best_products(dict(zip(ids.tolist(), m.tolist())), asked.__contains__, 3)
        assert got == {(q, c, s) for q, _, c, s in want}


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(80)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(None, 3), (7, 7)]
    label = {}
    for a, b in edges:
        if a is not None and a != b:
            la, lb = label.setdefault(a, a), label.setdefault(b, b)
            label = {k: min(la, lb) if c in (la, lb) else c for k, c in label.items()}
    got = components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r.id: r.component for r in got} == label and len(got) == len(label)
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, name):
    assert name in entry.queries()
    if name in ORACLES:
        res = compare(spark, SF, [name], verbose=False)[name]
        assert res.startswith("OK"), res
        return
    table, key = ("pages", "page_id") if name.startswith("op4") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = QUERIES[name](spark, SF)
    assert {r[0] for r in got.select(key).collect()} == ids


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(2).withColumn("doc_id", F.col("doc_id") + 1_000_000)
    odd = spark.createDataFrame([(2_000_000, None, None, None, None), (2_000_001, "12 34", None, None, None)],
                                docs.schema)
    seen = docs.union(extra).union(odd)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = scratch_path(spark, f"test-{name}", unique=True)
        stage(spark, seen, SF).write.parquet(path)
        new = spark.read.parquet(path)
        ids, before = ({r.doc_id for r in d.select("doc_id").collect()} for d in (new, seen))
        if k == 0:
            assert before - ids == {2_000_000, 2_000_001} | (before - ids - {2_000_000, 2_000_001})
            assert len(before - ids) <= 4
        if k == 1:
            assert {1_000_000 + r.doc_id for r in docs.limit(2).collect()} & ids == set()
        if k in (2, 3, 4):
            assert ids == before
        if k < 4:
            assert new.columns == docs.columns
        if k == 3:
            assert new.filter("text rlike 'AKIA[A-Z0-9]{16}|[0-9a-f]{24}'").count() == 0
            assert new.filter("n_chars <> length(text)").count() == 0
        seen = new
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_keep_columns_of_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mine = {c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in (
        "lang_pred", "score", "rejected", "kept_text", "n_removed", "component_id", "spans", "blob", "id", "chunk")}
    seen = docs.select("*", *(v.alias(c) for c, v in mine.items()))
    columns = seen.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        path = scratch_path(spark, f"test-clash-{name}", unique=True)
        stage(spark, seen, SF).write.parquet(path)
        seen = spark.read.parquet(path)
        assert seen.columns == columns
        for c, v in mine.items():
            assert seen.filter(~F.col(c).eqNullSafe(v)).count() == 0, (name, c)
    assert seen.count() > 0


def test_pipeline_run_is_registered(spark):
    assert entry.queries()["pipeline"](spark, SF).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_language_model_is_deterministic():
    sample = [("en", "the cat and the dog"), ("fr", "le chat et le chien")] * 10
    a, b = langid.train(sample), langid.train(sample)
    assert (a.weights == b.weights).all()


def documents(spark, rows):
    """Rows ``(doc_id, text)`` with the other columns of documents and one more."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, at int")
    more = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in ("doc_id", "text")]
    return frame.select("doc_id", "text", *more, "at")


def test_passages_of_repeated_rows_shared_and_null_ids(spark):
    passage, other, third = (" ".join(f"{c}{k}" for k in range(25)) for c in "abc")
    rows = [(1, passage), (1, passage), (2, f"own  {other}"), (2, "short\ttext"), (3, f"x {other} y"),
            (None, third), (None, third), (4, f"{third} end"), (None, None)]
    got = corpus_pipeline.drop_repeated_passages(spark, documents(spark, rows), SF)
    assert got.columns == documents(spark, rows).columns
    text = {r.at: r.text for r in got.collect()}
    assert len(text) == len(rows) and got.filter("n_chars <> length(text)").isEmpty()
    assert sorted([text[0], text[1]]) == ["", passage]  # the first copy stays whole
    assert sorted([text[5], text[6]]) == ["", third]
    assert [text[k] for k in (2, 3, 4, 7, 8)] == [f"own  {other}", "short\ttext", "x y", "end", None]


def test_one_of_each_with_shared_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(1, a), (1, b), (1, a), (2, f"{b} more"), (3, c), (None, c), (None, d), (None, d), (None, f"{d} more"),
            (4, ""), (5, None), (None, None), (None, None), (5, "")]
    got = corpus_pipeline.keep_one_of_each(spark, documents(spark, rows), SF)
    assert got.columns == documents(spark, rows).columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert (None, d) in kept or (None, f"{d} more") in kept
    assert [k for k in kept if not (k[0] is None and k[1])] == sorted(
        [(1, a), (1, b), (3, c), (4, ""), (5, None), (None, None), (5, "")], key=repr)
    assert sum(k[0] is None and bool(k[1]) for k in kept) == 1
