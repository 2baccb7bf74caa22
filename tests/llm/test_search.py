"""Nearest vectors and quality votes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import ann, quality

from ..conftest import SF


def brute(rows, query, k=5):
    q = np.array(dict(rows)[query], float)
    out = []
    for i, v in rows:
        if i != query:
            v = np.array(v, float)
            out.append((-float(v @ q) / (np.linalg.norm(v) * np.linalg.norm(q)), i))
    return sorted(out)[:k]


def test_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = ann.nearest(table.withColumns({"k1": F.lit(1), "rank": F.lit(2)}), F.col("vec_id") % 50 == 0).collect()
    hits = total = 0
    for query in {r.query_id for r in found}:
        want = brute(rows, query)
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        exact = {i: -s for s, i in brute(rows, query, len(rows))}
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in got)
        hits, total = hits + len({i for _, i in want} & {g[1] for g in got}), total + 5
    assert {r.query_id for r in found} == {i for i, _ in rows if i % 50 == 0}
    assert hits >= 0.9 * total


def test_ties_copies_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 3)
    monkeypatch.setattr(ann, "PART_QUERIES", 1)
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 40)] + [(100 + i, rng.standard_normal(3).tolist()) for i in range(30)]
    rows += [(50, [2.0, 4.0, 6.0]), (50, [2.0, 4.0, 6.0])]
    odd = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 2.0]), (204, []),
           (205, [float("inf"), 1.0, 1.0]), (206, [1.0, 2.0]), (None, same)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = ann.nearest(table, F.col("vec_id") % 50 == 0).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50, 100)}
    assert {r.query_id for r in found} == {0, 50, 100}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    want = brute(rows, 100)
    assert [s for _, s in got[100]] == pytest.approx([-s for s, _ in want])


def test_probes_on_until_enough_are_found(spark, monkeypatch):
    rng = np.random.default_rng(4)
    near = [(i, [1.0, *(0.01 * rng.standard_normal(3)).tolist()]) for i in range(1000)]
    far = [(1000 + 50 * i, [-1.0, *(0.01 * rng.standard_normal(3)).tolist()]) for i in range(3)]
    two = ann.Lists(np.array([[1.0, 0, 0, 0], [-1.0, 0, 0, 0]]), 1, np.eye(4))
    monkeypatch.setattr(ann, "fit", lambda *_: two)
    table = spark.createDataFrame(near + far, "vec_id long, embedding array<double>")
    found = ann.nearest(table, F.col("vec_id") % 50 == 0).collect()
    for query in {i for i, _ in near + far if i % 50 == 0}:
        got = [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == query]
        assert got == [i for _, i in brute(near + far, query)]


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 0.5])], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(one, F.col("vec_id") == 0).collect()] == [(0, 1, 3)]
    assert ann.nearest(one.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(one, F.col("vec_id") == 7).count() == 0


def test_abandoning_keeps_the_nearest():
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((3000, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    blocks = [np.ascontiguousarray(rows[:, c : c + 16].astype(np.float32)) for c in range(0, 64, 16)]
    kept = total = 0
    for q in rows[:60]:
        near = set(ann.scan(q.astype(np.float32), blocks, 6).tolist())
        want = np.argsort(((rows - q) ** 2).sum(axis=1))[:6].tolist()
        kept, total = kept + len(near & set(want)), total + 6
        assert len(near) < 100
    assert kept >= 0.97 * total


def test_votes_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    model = quality.train(docs, labels, learn_from=rest != 0)
    scored = quality.score(docs, model, ["doc_id"]).join(labels, "doc_id").where(rest == 0).collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert np.mean([g > b or 0.5 * (g == b) for g in good for b in bad]) > 0.85
    assert np.mean([g >= 0.3 for g in good]) > 0.95


def test_votes_by_hand(spark):
    texts = ["good plain words here", "good plain words there", "BAD!! BAD!! BAD!!", "WORSE!! BAD!!", "x | y | z", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"label": F.lit(3), "score": F.lit(4)})
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0), (2, None), (9, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = [quality.terms(t.encode() if t else None) for t in texts]
    vectors, got = model.embed(rows), model.score(rows, 3)
    for v, s in zip(vectors, got):
        cosine = np.maximum(model.vectors @ v, 0).astype(float)
        near = np.argsort(-cosine)[:3]
        weight = cosine[near] ** 2
        assert s == pytest.approx((weight * model.labels[near]).sum() / weight.sum() if weight.sum() else model.prior, abs=1e-6)
    out = {r.doc_id: r.s for r in quality.score(docs, model, ["doc_id"], name="s").collect()}
    assert out[5] == out[6] == model.prior == 0.5 and out[0] > 0.9 and out[2] < 0.1
    assert quality.score(docs, model, docs.columns, name="s").columns == [*docs.columns, "s"]


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs, quality.train(docs, none), ["doc_id"]).first().score == 0.5
    empty = docs.limit(0)
    assert quality.score(empty, quality.train(empty, none), ["doc_id"]).count() == 0
