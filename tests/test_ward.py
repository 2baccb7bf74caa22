"""Ward merging in rounds against the greedy method by brute force."""

import numpy as np
import pytest

from lumenframe.operators import ward


def greedy(n, x, k):
    """Merge the cheapest pair until k clusters are left; members of each."""
    groups = [([i], float(n[i]), x[i]) for i in range(len(n))]
    while len(groups) > k:
        cost = [(a[1] * b[1] / (a[1] + b[1]) * ((a[2] - b[2]) ** 2).sum(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = min(cost)
        a, b = groups[i], groups[j]
        groups = [g for t, g in enumerate(groups) if t not in (i, j)]
        groups.append((a[0] + b[0], a[1] + b[1], (a[1] * a[2] + b[1] * b[2]) / (a[1] + b[1])))
    return {frozenset(g[0]) for g in groups}


@pytest.mark.parametrize("local", [4096, 20])
def test_same_clusters_as_the_greedy_method(spark, monkeypatch, local):
    monkeypatch.setattr(ward, "LOCAL", local)
    monkeypatch.setattr(ward, "BLOCK", 30)
    monkeypatch.setattr(ward, "PAIRS", 500)
    rng = np.random.default_rng(5)
    size = 120
    x, n = rng.uniform(0, 10, (size, 2)), rng.integers(1, 9, size)
    cells = spark.createDataFrame([(i, int(w), float(a), float(b)) for i, (w, (a, b)) in enumerate(zip(n, x))], "cell int, n long, a double, b double")
    found = ward.clusters(cells, ["a", "b"], 7).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.cluster, set()).add(r.cell)
    assert {frozenset(g) for g in groups.values()} == greedy(n, x, 7)


def test_merges_have_growing_costs_and_few_cells(spark):
    x = np.array([[0.0], [1.0], [1.5], [9.0]])
    got = sorted(ward.merge_in_memory(np.arange(4), np.ones(4), x), key=lambda m: m[2])
    assert [m[2] for m in got] == pytest.approx([0.125, 2 / 3 * 1.25**2, 3 / 4 * (9 - 2.5 / 3) ** 2]) and got[0][:2] == (1, 2)
    cells = spark.createDataFrame([(1, 2.0), (1, 5.0)], "n long, a double")
    assert {r.cluster for r in ward.clusters(cells, ["a"], 5).collect()} == {r.cluster for r in ward.clusters(cells, ["a"], 2).collect()}
    assert len({r.cluster for r in ward.clusters(cells, ["a"], 1).collect()}) == 1
    assert ward.clusters(cells.limit(0), ["a"], 3).count() == 0


def test_equal_points(spark):
    cells = spark.createDataFrame([(1, float(i // 3), 0.0) for i in range(9)], "n long, a double, b double").groupBy("a", "b").sum("n").withColumnRenamed("sum(n)", "n")
    assert len({r.cluster for r in ward.clusters(cells, ["a", "b"], 3).collect()}) == 3
    got = ward.merge_in_memory(np.arange(4), np.ones(4), np.zeros((4, 2)))
    assert len(got) == 3 and {m[2] for m in got} == {0.0}
