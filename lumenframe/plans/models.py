"""Supervised models on the driver tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import classify, kernel_ridge, kernel_solver, neural, ols, regress, trees
from ..operators import joins as J
from ..operators import metrics as M
from ..operators.features import dummies, dummy_names, interactions, polynomial_terms, range_scale, with_fold, with_split
from ..operators.frame import threshold_flag
from ..runtime import cut_lineage, lookup, spread_table, table
from .joins import ATOMS, molecules
from .registry import query


def part_of(df, name):
    return df.where(F.col("part") == name).drop("part")


def digits(spark, sf):
    """Ten-class vectors, split 90/10 by key."""
    rows = table(spark, sf, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    return with_split(rows, "vec_id", 0.9)


HEART = ["o_totalprice", "o_orderpriority", "c_nationkey", "c_acctbal", "c_mktsegment"]


def heart(spark, sf):
    """Mixed columns with a two-valued label."""
    orders = spread_table(spark, sf, "orders", "o_orderkey").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("status"),
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return with_split(lookup(orders, customer, ["c_custkey"]), "o_orderkey", 0.9)


# The factor levels of the driver tables.
FLAGS = {"l_returnflag": ["A", "N", "R"], "p_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}
NUMBERS = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
CODED = [*NUMBERS, *dummy_names(FLAGS)]


def insurance(spark, sf):
    """Price of a line from its numbers and factors, split 80/20 by key."""
    items = spread_table(spark, sf, "lineitem", "l_orderkey").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"),
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice",
    )
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    rows = lookup(items, part, ["p_partkey"]).withColumn("size_rng", threshold_flag(F.col("p_size"), 30).cast("double"))
    return with_split(rows.withColumns(dummies(FLAGS)), ["l_orderkey", "l_linenumber"], 0.8)


def label_report(scored):
    cells = M.confusion(scored, "label", "prediction")
    accuracy = M.accuracy(cells).select("accuracy").scalar()
    return M.by_label(cells).withColumn("accuracy", accuracy)


@query("logistic_regression")
def logistic_regression(spark, sf):
    rows = digits(spark, sf)
    model = classify.logistic(reg=0.01, iterations=20).fit(part_of(rows, "train"))
    return label_report(model.transform(part_of(rows, "test")))


@query("random_forest_classifier")
def random_forest_classifier(spark, sf):
    rows = digits(spark, sf)
    model = classify.forest(trees=10, depth=6).fit(part_of(rows, "train"))
    return label_report(model.transform(part_of(rows, "test")))


def hashed_heart(spark, sf, written=False):
    """Heart rows as vectors of hashed features, with the label of the later name as 1;
    ``written`` once for jobs that read them many times."""
    rows = heart(spark, sf)
    if written:
        rows = cut_lineage(rows.select("o_orderkey", *HEART, "status", "part"))
    ready = classify.hashed_features(HEART, "status").fit(part_of(rows, "train")).transform(rows)
    return part_of(ready, "train"), part_of(ready, "test")


# The grid of the job.
HEART_TREES = {"maxDepth": [5, 10, 15], "maxBins": [20, 50, 100], "impurity": ["entropy", "gini"]}


@query("decision_tree_classifier")
def decision_tree_classifier(spark, sf):
    """The published job: 18 settings by five folds, by area under ROC, and the report of the best on the test rows."""
    train, test = classify.filled(*hashed_heart(spark, sf, written=True))
    model, _ = classify.tuned(with_fold(train, "o_orderkey", 5), classify.tree(), HEART_TREES, "auc", "fold", 5)
    return label_report(model.transform(test))


@query("score_table")
def score_table(spark, sf):
    rows = heart(spark, sf)
    model = classify.fitted(classify.hashed_pipeline(HEART, "status", classify.forest(trees=5)), part_of(rows, "train"))
    scored = model.transform(part_of(rows, "test"))
    return scored.select("o_orderkey", "label", "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("p"))


@query("area_under_roc_of_model")
def area_under_roc_of_model(spark, sf):
    scored = score_table(spark, sf)
    return M.area_under_roc(scored, "p", F.col("label") == 1)


def last_year_apart(spark, sf):
    """Training rows of all years before the last one, test rows of the last one."""
    items = spread_table(spark, sf, "lineitem", "l_orderkey").select(
        F.month("l_shipdate").alias("month"), F.dayofmonth("l_shipdate").alias("day"),
        "l_shipdate", "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice",
    )
    xs = ["month", "day", "l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = regress.vectors(items, xs, "l_extendedprice")
    year = items.agg(F.max(F.year("l_shipdate"))).first()[0]
    newest = F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")
    return rows.where(~newest), rows.where(newest)


@query("random_forest_regressor")
def random_forest_regressor(spark, sf):
    """All years before the last one train, the last one tests; sizes of both are reported."""
    train, test = last_year_apart(spark, sf)
    model = regress.forest(trees=10, depth=6).fit(train)
    metrics = M.regression_metrics(model.transform(test), "label", "prediction")
    return metrics.withColumnRenamed("n", "n_test").withColumn("n_train", F.lit(train.count()))


@query(
    "linear_regression",
    """select l_returnflag, count(*) as n, round(regr_slope(l_extendedprice, l_quantity), 4) as slope,
              round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept from lineitem group by 1""",
)
def linear_regression(spark, sf):
    model = ols.fit(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    return model.select(
        "l_returnflag", "n", F.round(F.get("coef", F.lit(0)), 4).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


@query("linear_regression_factors")
def linear_regression_factors(spark, sf):
    rows = insurance(spark, sf)
    scored = ols.predict(part_of(rows, "test"), ols.fit(part_of(rows, "train"), "l_extendedprice", CODED), CODED)
    return M.regression_metrics(scored, "l_extendedprice", "prediction")


@query(
    "regression_summary",
    """with m as (select count(*) as n, regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a,
                         regr_r2(l_extendedprice, l_quantity) as r2, var_pop(l_quantity) as vx, avg(l_quantity) as mx, var_pop(l_extendedprice) as vy from lineitem),
       e as (select l_extendedprice - a - b * l_quantity as e from lineitem, m),
       s as (select *, sqrt(n * vy * (1 - r2) / (n - 2)) as sigma from m)
       select n, round(a, 3) as intercept, round(b, 4) as slope, round(sigma / sqrt(n * vx), 6) as slope_se, round(b / (sigma / sqrt(n * vx)), 3) as slope_t,
              round(r2, 8) as r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 8) as r2adj, round(sigma, 3) as sigma,
              (select round(min(e), 3) from e) as e_min, (select round(quantile_cont(e, 0.25), 3) from e) as e_q1, (select round(quantile_cont(e, 0.5), 3) from e) as e_median,
              (select round(quantile_cont(e, 0.75), 3) from e) as e_q3, (select round(max(e), 3) from e) as e_max from s""",
)
def regression_summary(spark, sf):
    s = regress.residual_summary(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])

    def first(c):
        return F.get(c, F.lit(0))

    return s.select(
        "n",
        F.round("intercept", 3).alias("intercept"),
        F.round(first("coef"), 4).alias("slope"),
        F.round(first("se"), 6).alias("slope_se"),
        F.round(first("t"), 3).alias("slope_t"),
        F.round("r2", 8).alias("r2"),
        F.round("r2adj", 8).alias("r2adj"),
        F.round("sigma", 3).alias("sigma"),
        *[F.round(f"e_{q}", 3).alias(f"e_{q}") for q in ("min", "q1", "median", "q3", "max")],
    )


PAIRS = [
    ("size_rng", "l_returnflag_R"),
    ("p_size", "l_returnflag_R"),
    ("l_quantity", "l_returnflag_R"),
    ("l_quantity", "p_size"),
    ("l_quantity", "size_rng"),
]


@query("interaction_search")
def interaction_search(spark, sf):
    train = part_of(insurance(spark, sf), "train").withColumns(interactions(PAIRS))
    choices = {f"{a}*{b}": ("l_extendedprice", [*CODED, "size_rng", f"{a}:{b}"]) for a, b in PAIRS}
    return ols.fit_choices(train, choices).select("choice", "r2", "r2adj").orderBy(F.desc("r2"))


@query("lasso_cv")
def lasso_cv(spark, sf):
    train = with_fold(part_of(insurance(spark, sf), "train"), ["l_orderkey", "l_linenumber"], 5)
    xs = [*CODED, "size_rng"]
    return regress.lasso_table(spark, xs, regress.lasso_cv(train, "l_extendedprice", xs, "fold"))


@query("polynomial_regression")
def polynomial_regression(spark, sf):
    rows = polynomial_terms(polynomial_terms(insurance(spark, sf), "l_quantity", 3), "p_size", 2)
    rows = rows.withColumns(interactions([("size_rng", "l_returnflag_R")]))
    powers = ["l_quantity_1", "l_quantity_2", "l_quantity_3", "p_size_1", "p_size_2"]
    xs = [*powers, *[c for c in CODED if c not in ("l_quantity", "p_size")], "size_rng", "size_rng:l_returnflag_R"]
    scored = ols.predict(part_of(rows, "test"), ols.fit(part_of(rows, "train"), "l_extendedprice", xs), xs)
    return M.regression_metrics(scored, "l_extendedprice", "prediction")


LINE = ["l_orderkey", "l_linenumber"]


def insurance_vectors(spark, sf, written=False):
    """Training and test rows; ``written`` once for jobs that read them many times."""
    rows = insurance(spark, sf)
    if written:
        rows = cut_lineage(rows.select(*LINE, *CODED, "l_extendedprice", "part"))
    rows = regress.vectors(rows, CODED, "l_extendedprice")
    return part_of(rows, "train"), part_of(rows, "test")


@query("regression_tree_grid")
def regression_tree_grid(spark, sf):
    train, test = insurance_vectors(spark, sf, written=True)
    inner = with_fold(with_split(train, LINE, 0.8, seed=7), LINE, 10)
    parts = [part_of(inner, "train"), part_of(inner, "test"), test]
    # The grid.
    return regress.tree_grid(*parts, [10, 15, 20], [10, 15, 20, 25, 30])


@query("regression_tree_pruned")
def regression_tree_pruned(spark, sf):
    """Complexity table of a tree, with the error of its pruned forms on the test rows."""
    train, test = insurance_vectors(spark, sf, written=True)
    found, nodes, falls = regress.pruning_table(train, LINE, depth=8, complexity=1e-4)
    levels = [r["cp"] for r in found.orderBy("level").collect()]
    errors = regress.errors_by_form([(test, nodes, [(falls, levels)])])
    rows = [(i, e["rmse"], e["r2"]) for i, e in enumerate(errors)]
    return found.join(F.broadcast(spark.createDataFrame(rows, "level int, test_rmse double, test_r2 double")), "level")


@query("random_forest_oob")
def random_forest_oob(spark, sf):
    """Error of a forest on the rows its trees have not seen: three features at a split, as published."""
    train, _ = insurance_vectors(spark, sf, written=True)
    learner = regress.forest(trees=1, depth=6, subset="3")
    nodes = trees.fit_bootstrapped(train, LINE, learner, trees=20)
    scored = trees.out_of_bag(train, LINE, nodes, [*LINE, "label"])
    rows = scored.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("oob_trees").alias("trees_per_row"))
    return M.regression_metrics(scored, "label", "prediction").crossJoin(F.broadcast(rows))


@query("forest_importance")
def forest_importance(spark, sf):
    train, _ = insurance_vectors(spark, sf)
    return trees.importance(spark, trees.nodes_of(spark, regress.forest(trees=20, depth=6, subset="3").fit(train)), CODED)


@query("bagged_trees_cv")
def bagged_trees_cv(spark, sf):
    train, test = insurance_vectors(spark, sf, written=True)
    return regress.bagging_cv(train, test, LINE, folds=10, bag=25, depth=6)


@query("bagged_trees_importance")
def bagged_trees_importance(spark, sf):
    train, _ = insurance_vectors(spark, sf)
    return trees.importance(spark, trees.nodes_of(spark, regress.bagging(25, 6).fit(train)), CODED)


@query("bagged_trees")
def bagged_trees(spark, sf):
    """25 bagged trees, as published: errors on the test rows, and their means over ten folds of the training rows."""
    train, test = insurance_vectors(spark, sf, written=True)
    found = regress.bagging_cv(train, test, LINE, folds=10, bag=25, depth=6)
    crossed = F.broadcast(found.where("part = 'mean'").select(*[F.col(c).alias(f"cv_{c}") for c in ("n", "mae", "mse", "rmse", "r2")]))
    return found.where("part = 'test'").drop("part").crossJoin(crossed)


@query("model_tree")
def model_tree(spark, sf):
    train, test = insurance_vectors(spark, sf)
    return M.regression_metrics(regress.model_tree(train, test, CODED), "label", "prediction")


@query("mlp_regressor")
def mlp_regressor(spark, sf):
    rows = with_split(table(spark, sf, "part").withColumns(dummies({"p_type": FLAGS["p_type"]})), "p_partkey", 0.8)
    xs = ["p_partkey", "p_size", *dummy_names({"p_type": FLAGS["p_type"]})]
    train = rows.where("part = 'train'")
    scaled = range_scale(rows, ["p_partkey", "p_size", "p_retailprice"], train)
    net = neural.fit(part_of(scaled, "train"), xs, "p_retailprice", hidden=5, steps=40)
    return M.regression_metrics(neural.predict(part_of(scaled, "test"), net, xs), "p_retailprice", "prediction")


def energies(spark, sf):
    """Inverse-distance descriptors with an energy that depends on them."""
    described = J.inverse_distance_descriptor(molecules(spark, sf), "vec_id", F.col("atoms"))
    total = F.aggregate("descriptor", F.lit(0.0), lambda s, x: s + x)
    return with_split(described.withColumn("energy", total * total), "vec_id", 0.8)


@query("kernel_ridge_fit")
def kernel_ridge_fit(spark, sf):
    rows = energies(spark, sf)
    train, test = part_of(rows, "train"), part_of(rows, "test")
    marks, weights = kernel_ridge.fit(train, "vec_id", "descriptor", "energy", 1e-6, 0.04, m=200)
    scored = kernel_ridge.predict(test, "descriptor", marks, weights, 0.04)
    return M.regression_metrics(scored, "energy", "prediction")


def kernel_ridge_exact(spark, sf):
    """Weights over all training rows, scored on the test rows, with the steps the solver took."""
    rows = energies(spark, sf)
    train, test = part_of(rows, "train"), part_of(rows, "test")
    solution, about = kernel_solver.solve(train, "vec_id", "descriptor", "energy", 1e-4, 0.04, m=200)
    scored = test.join(kernel_solver.predict(test, "vec_id", "descriptor", solution, about), "vec_id")
    return M.regression_metrics(scored, "energy", "prediction").withColumns({"steps": F.lit(about["steps"]), "residual": F.lit(about["error"])})


@query(
    "kernel_ridge_predict",
    f"""with {ATOMS}, d as (select vec_id, list(inverse order by i, j) as x from pairs group by 1),
        marks as (select x as l, row_number() over (order by md5(cast(vec_id as varchar)), vec_id) as r from d order by r limit 50)
        select vec_id, round(sum(exp(-0.04::double * pow(list_distance(x, l), 2)) / r), 6) as prediction from d, marks group by 1""",
)
def kernel_ridge_predict(spark, sf):
    rows = energies(spark, sf)
    marks = kernel_ridge.landmark_matrix(rows, "vec_id", "descriptor", 50)
    scored = kernel_ridge.predict(rows, "descriptor", marks, 1 / np.arange(1, len(marks) + 1), 0.04)
    return scored.select("vec_id", F.round("prediction", 6).alias("prediction"))


@query("compare_trained_models")
def compare_trained_models(spark, sf):
    train, test = insurance_vectors(spark, sf, written=True)
    y = "label"
    tree, m5, forest = regress.grown(train, LINE, [regress.tree(20, 8), regress.model_tree_learner(CODED), regress.forest(10, 6)])
    scored = {
        "Linear Model": ols.predict(test, ols.fit(train, y, CODED), CODED),
        "Regression Tree": trees.mean_prediction(test, tree, [y]),
        "M5": regress.model_tree(train, test, CODED, nodes=m5),
        "Random Forest": trees.mean_prediction(test, forest, [y]),
    }
    return M.compare_models(scored, y)
