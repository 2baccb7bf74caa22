"""Headline timings: one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.evaluation import MulticlassClassificationEvaluator  # noqa: E402

from lumenframe.operators import classify, nested, tuning  # noqa: E402
from lumenframe.operators.features import with_fold  # noqa: E402
from lumenframe.plans import QUERIES  # noqa: E402
from lumenframe.plans.models import digits, part_of  # noqa: E402
from lumenframe.runtime import session  # noqa: E402

HEADLINE = [
    "read_fixed_width", "tfidf", "semantic_search", "numeric_summary", "boxplot_stats", "pearson_matrix",
    "spearman_pairs", "spearman_discretized", "area_under_roc", "precision_recall_by_threshold",
    "one_hot_grouped", "frequent_itemsets", "association_rules", "cf_subclusters", "cf_global_clusters",
    "linear_regression_factors", "lasso_cv", "random_forest_regressor", "decision_tree_classifier",
    "kernel_ridge_fit", "grid_search_min_fold", "adf_test", "kpss_test", "arma_order_select",
    "rolling_forecast", "var_forecast_rolling", "text_scorer",
]


def logistic_grid(spark, sf):
    """54 settings on one 80/20 split: the published logistic grid."""
    learner = classify.logistic()
    # The published grid.
    maps = tuning.param_maps(
        learner, regParam=[0.1, 0.3, 0.01], maxIter=[10, 20, 100], elasticNetParam=[0.0, 0.5, 1.0], fitIntercept=[True, False]
    )
    train = part_of(digits(spark, sf), "train").repartition(spark.sparkContext.defaultParallelism, "vec_id")
    model = tuning.train_validation(train, "vec_id", learner, MulticlassClassificationEvaluator(), maps, 0.8)
    return tuning.scores_table(spark, model, maps)


def forest_grid(spark, sf):
    """54 settings x 5 folds: the published forest grid, depths and sizes from shared fits."""
    # The published grid.
    choices = {"maxDepth": [5, 10, 15], "maxBins": [30, 50, 100], "impurity": ["entropy", "gini"], "numTrees": [5, 10, 20]}
    train = with_fold(part_of(digits(spark, sf), "train"), "vec_id", 5).select("label", "features", "fold")
    scores, best = nested.cross_validate(train, classify.forest(), choices, "f1", "fold", 5)
    nested.refit(train, classify.forest(), best)
    return scores


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench", int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)))
    jobs = {name: QUERIES[name] for name in HEADLINE}
    if os.environ.get("BENCH_GRIDS", "1") == "1":
        jobs["logistic_grid_54"], jobs["forest_grid_54x5"] = logistic_grid, forest_grid
    QUERIES["group_count"](spark, sf).write.format("noop").mode("overwrite").save()
    QUERIES["partition_function"](spark, sf).write.format("noop").mode("overwrite").save()
    took = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job(spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
