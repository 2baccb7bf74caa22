"""Model trees: pruning and smoothing by hand, and against leaf models without them."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lumenframe.operators import model_tree as M
from lumenframe.operators import regress, trees


def moments(x, y):
    z = np.column_stack([x, y])
    d = z - z.mean(0)
    return M.Moments(float(len(z)), z.mean(0), d.T @ d / len(z))


def three_nodes(x, y, at):
    """A root split at ``at`` and its two leaves."""
    def stats(y):
        return [len(y), y.sum(), (y * y).sum()]

    left = x[:, 0] <= at
    s = np.array([stats(y), stats(y[left]), stats(y[~left])])
    nodes = trees.Nodes(np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0, -1, -1]), np.array([at, 0, 0]), s, s[:, 0], np.array([0]), True)
    return nodes, {1: moments(x[left], y[left]), 2: moments(x[~left], y[~left])}, left


def test_sums_of_moments():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(50, 2)), rng.normal(size=50)
    both, whole = moments(x[:20], y[:20]) + moments(x[20:], y[20:]), moments(x, y)
    assert both.n == 50 and both.mean == pytest.approx(whole.mean) and both.cov == pytest.approx(whole.cov)


def test_one_line_is_pruned_and_two_are_kept():
    x = np.linspace(0, 1, 80)[:, None]
    noise = np.random.default_rng(1).normal(0, 0.01, 80)
    nodes, leaves, _ = three_nodes(x, 3 * x[:, 0] + 1 + noise, 0.5)
    grown = M.grow(nodes, leaves)
    assert grown.ends[0] and grown.models[0] == pytest.approx([1, 3], abs=0.02)
    y = np.where(x[:, 0] <= 0.5, x[:, 0], 5 - 4 * x[:, 0]) + noise
    nodes, leaves, left = three_nodes(x, y, 0.5)
    grown = M.grow(nodes, leaves)
    assert not grown.ends[0] and grown.ends[1] and grown.ends[2]
    root, one = M.linear_model(leaves[1] + leaves[2])[0], M.linear_model(leaves[1])[0]
    n = left.sum()
    assert grown.models[1] == pytest.approx((n * one + 15 * root) / (n + 15))
    assert M.grow(nodes, leaves, smoothing=0.0).models[1] == pytest.approx(one) and one == pytest.approx([0, 1], abs=0.03)


def test_useless_terms_leave():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4))
    x[:, 3] = 7.0
    model, error = M.linear_model(moments(x, 2 * x[:, 1] + rng.normal(0, 0.1, 60)))
    assert abs(model[2] - 2) < 0.1 and model[4] == 0 and error < 0.15
    noise = rng.normal(size=60)
    flat, _ = M.linear_model(moments(x[:, 3:], noise))
    assert flat == pytest.approx([noise.mean(), 0])
    assert np.isinf(M.linear_model(moments(x[:1], noise[:1]))[1])


def test_better_than_leaf_models_on_new_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (1500, 3))
    y = np.where(x[:, 0] < 0, 2 * x[:, 1], 1 - x[:, 1] + x[:, 2]) + rng.normal(0, 0.5, 1500)
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(i, float(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x))], "id long, label double, a double, b double, c double")
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    train, test = rows.where(F.col("id") % 3 > 0), rows.where(F.col("id") % 3 == 0)
    model = M.fit(train, names, depth=5, smallest=6)
    assert 2 <= (model.ends & (model.models != 0).any(axis=1)).sum() and model.ends.sum() < len(model.ends)

    def error(model):
        found = M.predict(test, model, names, ["id", "label"]).collect()
        assert len(found) == test.count()
        return np.sqrt(np.mean([(r.label - r.prediction) ** 2 for r in found]))

    # Every leaf with its own full model: no pruning, no smoothing.
    whole = np.zeros_like(model.models)
    leaf_of = trees.score(train, model.nodes, [*names, "label"], lambda n, p, m: {"leaf": p[-1][:, 0].astype(np.int32)}, {}, "leaf int").toPandas()
    for leaf, part in leaf_of.groupby("leaf"):
        z = np.column_stack([np.ones(len(part)), part[names]])
        whole[leaf] = np.linalg.lstsq(z, part["label"], rcond=None)[0]
    pruned, plain = error(model), error(M.ModelTree(model.nodes, model.nodes.leaf, whole))
    assert (pruned < plain, pruned < 0.6) == (True, True), (pruned, plain)
    assert regress.model_tree(train, test, names).columns == ["label", "prediction"]
