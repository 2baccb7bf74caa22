"""Trees grown side by side: those of Spark's learners, in a few passes for all of them."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from lumenframe.operators import classify, grow, model_tree, regress, trees, tuning
from lumenframe.plans import models
from lumenframe.plans import tuning as searches

from .conftest import SF


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 9, 700), rng.uniform(0, 1, 700), np.zeros(700), rng.integers(0, 2, 700)]).astype(float)
    y = 3 * (x[:, 0] > 4) + 2 * (x[:, 1] < 0.3) + x[:, 3] + rng.normal(0, 0.5, 700)
    data = [(i, i % 5, float(t), v.tolist()) for i, (t, v) in enumerate(zip(y, x))]
    found = spark.createDataFrame(data, "id long, fold int, label double, x array<double>")
    return found.select("id", "fold", "label", array_to_vector("x").alias("features")).persist()


@pytest.fixture
def passes(monkeypatch):
    """Counts passes over the rows, and lets none of Spark's learners read them."""
    plain, seen = grow._sums, []
    monkeypatch.setattr(grow, "_sums", lambda *a: (seen.append(1), plain(*a))[1])
    for learner in (DecisionTreeRegressor, RandomForestRegressor):
        monkeypatch.setattr(learner, "fit", lambda *a: pytest.fail("a fit by itself"))
    return seen


def guesses(rows, nodes):
    return {r.id: r.prediction for r in trees.mean_prediction(rows, nodes, ["id"]).collect()}


def test_trees_are_those_of_spark(spark, rows):
    learners = [DecisionTreeRegressor(maxDepth=6, minInstancesPerNode=n, maxBins=b) for n, b in ((1, 32), (6, 10))]
    specs = [grow.spec_of(t, held=(0, f)) for t in learners for f in (-1, 0, 3)]
    data = grow.binned(rows, specs, [F.col("fold")])
    for spec, grown, own in zip(specs, grow.grow(data, specs), [t for t in learners for _ in range(3)]):
        fitted = own.fit(rows.where(F.col("fold") != spec.held[1]))
        want = trees.nodes_of(spark, fitted)
        got = grown.nodes(data)
        assert len(got.left) == len(want.left) and sorted(got.rows) == sorted(want.rows)
        assert guesses(rows, got) == pytest.approx({r.id: r.prediction for r in fitted.transform(rows).collect()})
        assert sorted(got.error) == pytest.approx(sorted(want.error), abs=1e-8)


def test_trees_do_not_depend_on_waves_or_blocks(rows, monkeypatch):
    specs = [grow.Spec(4, tried="2", seed=t, bag=t % 3, held=(0, f)) for t in range(6) for f in (-1, 1)]
    codes = trees.bootstrap_codes(["id"], 3)
    data = grow.binned(rows, specs, [F.col("fold")], codes, 3)
    want = [t.nodes(data) for t in grow.grow(data, specs)]
    monkeypatch.setattr(grow, "HELD", 1 << 13)
    monkeypatch.setattr(grow, "TOGETHER", 1)
    alone = grow.binned(rows, specs, [F.col("fold")], codes, 3)
    for a, b in zip([t.nodes(alone) for t in grow.grow(alone, specs)], want, strict=True):
        assert a.stats == pytest.approx(b.stats) and (a.feature == b.feature).all()
    drawn = np.array([list(trees.drawn(np.array(r.w))) for r in rows.select(codes.alias("w")).collect()])
    assert [n.weight[0] for n, s in zip(want, specs) if s.held[1] < 0] == [drawn[:, t % 3].sum() for t in range(6)]


def test_missing_numbers_are_an_error(rows):
    with pytest.raises(Exception, match="finite"):
        grow.binned(rows.withColumn("label", F.when(F.col("id") > 0, F.col("label"))), [grow.Spec(2)])


def test_cross_validated_bags_share_their_passes(rows, passes):
    found = {r.part: r for r in regress.bagging_cv(rows.where("id % 4 > 0"), rows.where("id % 4 = 0"), ["id"], folds=4, bag=6, depth=5).collect()}
    assert len(passes) <= 5 and found["test"].r2 > 0.8 and found["mean"].r2 > 0.8 and found["mean"].n == 525


def test_rows_of_equal_keys_are_drawn_by_themselves(rows, monkeypatch):
    plain, seen = grow.binned, []
    monkeypatch.setattr(grow, "binned", lambda *a, **k: (seen.append(plain(*a, **k)), seen[-1])[1])
    regress.bagging_cv(rows.withColumn("id", F.col("id") % 20), rows, ["id"], folds=2, bag=3, depth=2)
    assert seen[0].table.select("draws").distinct().count() > 20


def test_bootstrapped_trees_share_their_passes(rows, passes):
    nodes = trees.fit_bootstrapped(rows, ["id"], RandomForestRegressor(maxDepth=4, featureSubsetStrategy="2"), trees=9)
    assert len(passes) <= 4 and len(nodes.roots) == 9


def test_trees_of_a_grid_and_of_a_pruning_table_share_their_passes(rows, passes):
    train, valid, test = (rows.where(F.col("id") % 7 < 5), rows.where("id % 7 = 5"), rows.where("id % 7 = 6"))
    grid = regress.tree_grid(train, valid, test, [4, 10], [2, 8]).collect()
    assert len(passes) <= 8 and len(grid) == 4 and max(r.r2 for r in grid) > 0.8
    passes.clear()
    table, _, _ = regress.pruning_table(rows, ["id"], depth=5, folds=4)
    assert len(passes) <= 5 and table.where("chosen").first().xerror < 0.2


def test_regression_tree_grid_has_ten_folds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(regress, "tree_grid", lambda *a: seen.append(a))
    models.regression_tree_grid(spark, SF)
    assert sorted(r.fold for r in seen[0][0].select("fold").distinct().collect()) == list(range(10))


def test_random_search_is_the_plain_search(rows, passes, monkeypatch):
    forest, evaluator = RandomForestRegressor(numTrees=1, bootstrap=False, featureSubsetStrategy="all", seed=1), RegressionEvaluator(metricName="r2")
    got = tuning.random_search(rows, "id", forest, evaluator, {"maxDepth": [1, 3, 4]}, 3, 3, 2).collect()
    assert len(passes) <= 8
    monkeypatch.undo()
    monkeypatch.setattr(grow, "supports", lambda learner: False)
    want = tuning.random_search(rows, "id", forest, evaluator, {"maxDepth": [1, 3, 4]}, 3, 3, 2).collect()
    assert [r.params for r in got] == [r.params for r in want]
    assert [r.metric for r in got] == pytest.approx([r.metric for r in want])


def test_random_search_is_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tuning, "random_search", lambda *a, **k: seen.append((a, k)))
    searches.random_search(spark, SF)
    (_, _, forest, _, choices), k = seen[0]
    assert (k["settings"], k["folds"], k["repeats"]) == (15, 10, 3) and forest.getNumTrees() >= 20
    assert len(tuning.grid(**choices)) >= 15


def test_different_learners_share_their_passes(spark, rows, passes, monkeypatch):
    named = rows.withColumn("a", F.get(models.vector_to_array("features"), F.lit(0)))
    learners = [regress.tree(9, 4), model_tree.learner(["a"], 3), regress.forest(5, 4, subset="2")]
    tree, m5, forest = regress.grown(rows, ["id"], learners)
    assert len(passes) <= 4 and len(forest.roots) == 5
    got = {r.label: r.prediction for r in regress.model_tree(named, named, ["a"], 3, nodes=m5).collect()}
    monkeypatch.undo()
    assert got == pytest.approx({r.label: r.prediction for r in regress.model_tree(named, named, ["a"], 3).collect()})
    assert guesses(rows, tree) == pytest.approx({r.id: r.prediction for r in learners[0].fit(rows).transform(rows).collect()})


def test_bagged_trees_are_cross_validated(spark):
    found = models.bagged_trees(spark, SF).first()
    train, test = models.insurance_vectors(spark, SF)
    assert found.n == test.count() and found.cv_n == train.count() and found.cv_rmse > 0


def test_decision_tree_is_tuned(spark, monkeypatch):
    plain, seen = classify.tuned, []

    def tuned(train, learner, choices, *more):
        seen.append((choices, more, train.select("fold").distinct().count()))
        model, scores = plain(train, learner, {"maxDepth": [2, 3]}, *more)
        assert scores.count() == 2
        return model, scores

    monkeypatch.setattr(classify, "tuned", tuned)
    assert models.decision_tree_classifier(spark, SF).count() == 2
    assert seen == [({"maxDepth": [5, 10, 15], "maxBins": [20, 50, 100], "impurity": ["entropy", "gini"]}, ("auc", "fold", 5), 5)]


def test_empty_places_do_not_change_a_tree(spark):
    train, test = models.hashed_heart(spark, SF)
    small, other = classify.filled(train, test)
    assert len(small.first().features) < 30 < len(train.first().features)
    want, got = (classify.tree(depth=4).fit(a).transform(b).select("o_orderkey", "prediction") for a, b in ((train, test), (small, other)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
