"""Language spans and interpolated scores, against plain computation."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenframe.llm import langid, lm

from ..conftest import SF

EN = "the cat sat on the mat and then the dog went with that other thing"
FR = "le chat est dans la maison avec une autre chose qui reste pour nous"
RU = "кошка сидит на окне и смотрит на улицу вместе с собакой"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, t, k) for i, (t, k) in enumerate([(EN, "en"), (FR, "fr"), (RU, "ru"), (None, "en"), (EN, None)] * 4)]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def label(spark, model, rows, schema="doc_id long, text string", **options):
    return {r[0]: r for r in langid.identify(spark.createDataFrame(rows, schema), model, ["doc_id"], **options).collect()}


def test_spans_of_mixed_text(spark, model):
    mixed = f"{EN}. {RU}! {FR}"
    found = label(spark, model, [(1, mixed)])[1]
    assert [s["lang"] for s in found.spans] == ["en", "ru", "fr"]
    assert [mixed[s["start"] : s["end"]] for s in found.spans] == [EN, RU, FR]


def test_undecided_and_repeated(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, EN), (4, EN), (None, FR)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in out) == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert all(0 <= r.score <= 1 for r in out)


def test_long_text_is_read_whole(spark, model, monkeypatch):
    text = (EN + " ") * 300 + (FR + " ") * 400
    whole = label(spark, model, [(1, text)])[1]
    assert whole.lang_pred == "fr" and [s["lang"] for s in whole.spans] == ["en", "fr"]
    parts = list(langid._strips([text.encode(), "é".encode() * 9], 1000))
    assert b"".join(p for n, p in parts if n == 0) == text.encode()
    assert all(p.decode() for n, p in parts)
    assert "".join(p.decode() for _, p in langid._strips(["é".encode() * 9], 5)) == "é" * 9


def test_no_language_and_clashing_names(spark, model):
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert label(spark, none, [(1, EN)])[1].lang_pred == "und"
    rows = spark.createDataFrame([(1, EN, "x", 0.5)], "doc_id long, text string, _c0 string, signs double")
    assert langid.identify(rows, model, rows.columns).first()["_c0"] == "x"
    assert langid.identify(rows.limit(0), model, ["doc_id"]).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(*[st.floats(-9, 0)] * 3), max_size=7), min_size=1, max_size=4), st.floats(0.1, 5))
def test_viterbi_is_optimal(texts, switch):
    scores = np.array([w for t in texts for w in t], np.float64).reshape(-1, 3)
    labels = langid.viterbi(scores, np.array([len(t) for t in texts]), switch)
    value = lambda t, path: sum(w[s] for w, s in zip(t, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
    at = 0
    for t in texts:
        got = value(t, labels[at : at + len(t)])
        at += len(t)
        best = [0.0] * 3
        for i, w in enumerate(t):
            best = [w[s] + (max(best[s], max(best) - switch) if i else 0) for s in range(3)]
        assert not t or abs(got - max(best)) < 1e-9


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    found = langid.identify(docs, langid.train(docs, learn_from=rest != 2), ["doc_id", "lang"], spans=False).where(rest == 2)
    assert found.where("lang_pred = lang").count() >= 0.95 * found.count()


def counted(texts):
    """Counts of tokens and of pairs, with contexts, in plain Python."""
    uni, pairs, context = Counter(), Counter(), Counter()
    for t in texts:
        words = [*t, None]
        uni.update(words)
        before = ["^", *t]
        pairs.update(zip(before, words))
        context.update(before)
    return uni, pairs, context


def test_scores_by_hand(spark, monkeypatch):
    random.seed(3)
    words = ["a", "b", "c", "D", "ü", "e.f"]
    texts = {i: " ".join(random.choices(words, k=random.randrange(0, 30))) for i in range(60)}
    texts |= {100: None, 101: "", 102: " \t\n", 103: "new words only", 104: "a " * 5000}
    role = {i: zlib.crc32(str(i).encode()) % 3 for i in texts}
    rows = [(i, t, role[i]) for i, t in texts.items()]
    rows.append((None, "a b", None))
    fixed = np.random.default_rng(1).dirichlet([1, 1, 1], lm.BUCKETS)
    monkeypatch.setattr(lm, "_learn", lambda events, orders: fixed)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    found = lm.score(spark.createDataFrame(rows, "doc_id long, text string, role int"), role=F.col("role")).collect()
    tokens = {i: [w.lower() if w.isascii() else w for w in (t or "").split()] for i, t in texts.items()}
    uni, pairs, context = counted([tokens[i] for i in texts if role[i] != lm.SCORED])
    total, types = sum(uni.values()), len(uni)
    assert len(found) == len(rows)
    for r in found:
        t = tokens.get(r.doc_id, ["a", "b"])
        score = 0.0
        for u, v in zip(["^", *t], [*t, None]):
            share = fixed[min(math.frexp(context[u])[1], lm.BUCKETS - 1)].copy()
            if not context[u]:
                share[2] = 0
                share /= share.sum()
            p2 = pairs[u, v] / context[u] if context[u] else 0
            score += math.log10(share[0] / (types + 1) + share[1] * uni[v] / total + share[2] * p2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t) + 1, sum(uni[w] > 0 for w in [*t, None]), total)
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (types + 1))) for w in [*t, None]))
        assert r.score == pytest.approx(score)


def test_weights_by_expectation_maximisation():
    # Estimates that are right three times in four, told by two ratios to the uniform one.
    events = [{"bucket": 3, "cell": [0, 4 * 6], "n": 750}, {"bucket": 3, "cell": [0, lm.NEVER], "n": 250}]
    weights = lm._learn(events, 3)
    best = max((np.log2((1 - w) + w * 64) * 750 + np.log2(1 - w) * 250, w) for w in np.linspace(0.01, 0.99, 981))[1]
    assert weights[3][2] == pytest.approx(best, abs=2e-3)
    assert weights.sum(axis=1) == pytest.approx(1) and (weights[5] == weights[3]).all()


def test_learned_scores_beat_the_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10))
    found = lm.score(docs, role=F.when(rest == 0, lm.SCORED).when(rest == 1, lm.DELETED).otherwise(lm.KEPT))
    held = found.where(rest == 0).agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 1.05 * held[0] and held[1] < 0


def test_empty_corpus(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = lm.score(spark.createDataFrame([(1, "x y")], "doc_id long, text string"), role=F.lit(lm.SCORED)).first()
    assert (only.n_known, only.train_tokens) == (0, 0) and only.score == pytest.approx(0)
