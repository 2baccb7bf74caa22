"""Ordered text scores: gradient by differences, recovery, probabilities."""

import numpy as np
import pytest

from lumenframe.operators import ordinal


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    row, term, weight = np.repeat(np.arange(30), 4), rng.integers(0, 9, 120), rng.uniform(0.5, 2, 120)
    level = rng.integers(0, 4, 30)
    at = np.concatenate([[-0.5, 0.1, -0.3], rng.normal(0, 0.5, 9)])
    exact = ordinal.gradient(at, row, term, weight, level, 4)
    for i in range(len(at)):
        step = np.zeros(len(at))
        step[i] = 1e-6
        ends = [ordinal.gradient(at + s, row, term, weight, level, 4)[0] for s in (step, -step)]
        assert exact[1 + i] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=1e-5, abs=1e-6)


def test_minimise():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(6, 6))
    a, b = a @ a.T + np.eye(6), rng.normal(size=6)
    got = ordinal.minimise(lambda x: (0.5 * x @ a @ x - b @ x, a @ x - b), np.zeros(6), 100, tolerance=1e-10)
    assert got == pytest.approx(np.linalg.solve(a, b), abs=1e-6)


def test_levels_of_texts(spark):
    rng = np.random.default_rng(2)
    good, bad, other = ["fine", "great", "lovely"], ["awful", "poor", "bad"], ["the", "and", "place", "food"]
    rows = []
    for i in range(600):
        level = int(rng.integers(1, 6))
        words = [str(rng.choice(good if rng.random() < (level - 1) / 4 else bad)) for _ in range(6)] + [str(w) for w in rng.choice(other, 4)]
        rows.append((i, words, level if i % 7 else None))
    rows += [(700, [], 3), (701, None, 3)]
    df = spark.createDataFrame(rows, "id long, words array<string>, label int")
    model = ordinal.fit(df, "words", "label", size=512)
    assert model.levels == [1, 2, 3, 4, 5] and (np.diff(model.cuts) > 0).all()
    found = {r.id: r for r in ordinal.score(df, model, "words", ["id"]).collect()}
    assert len(found) == 602 and all(sum(r.probabilities) == pytest.approx(1) and len(r.probabilities) == 5 for r in found.values())
    truth = [(r[2], found[r[0]]) for r in rows[:600] if r[2]]
    assert np.mean([abs(t - r.score) for t, r in truth]) < 0.8
    assert np.corrcoef([t for t, _ in truth], [r.mean_score for _, r in truth])[0, 1] > 0.8
    assert found[700].probabilities == found[701].probabilities


def test_one_or_no_level(spark):
    df = spark.createDataFrame([(1, ["a"], 2), (2, ["b"], 2)], "id long, words array<string>, label int")
    model = ordinal.fit(df, "words", "label", size=16)
    assert [r.score for r in ordinal.score(df, model, "words", ["id"]).collect()] == [2, 2]
    none = ordinal.fit(df.limit(0), "words", "label", size=16)
    assert none.levels == [] and ordinal.score(df, none, "words", ["id"]).count() == 0
