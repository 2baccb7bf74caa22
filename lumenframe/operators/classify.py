"""Classifiers: Spark's learners with the settings the jobs use."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, FeatureHasher, HashingTF, StringIndexer, VectorSlicer
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import fresh_path
from . import nested


def logistic(reg: float = 0.1, iterations: int = 20, elastic_net: float = 0.0, intercept: bool = True) -> LogisticRegression:
    return LogisticRegression(
        regParam=reg, maxIter=iterations, elasticNetParam=elastic_net, fitIntercept=intercept
    )


def forest(trees: int = 10, depth: int = 5, bins: int = 32, impurity: str = "gini", seed: int = 12345) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=bins, impurity=impurity, featureSubsetStrategy="auto", seed=seed
    )


def tree(depth: int = 5, bins: int = 32, impurity: str = "gini", seed: int = 100) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, maxBins=bins, impurity=impurity, seed=seed)


def hashed_features(features: list[str], label: str, n_features: int = 1234) -> Pipeline:
    """Mixed columns hashed into one vector, label indexed in alphabetical order, so that
    class 1 of a two-valued label is the later name.  An unknown label is an error."""
    hasher = FeatureHasher(inputCols=features, outputCol="features", numFeatures=n_features)
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    return Pipeline(stages=[indexer, hasher])


def hashed_pipeline(features: list[str], label: str, learner, n_features: int = 1234) -> Pipeline:
    """``hashed_features`` and a learner on them."""
    return Pipeline(stages=[*hashed_features(features, label, n_features).getStages(), learner])


def tuned(train: DataFrame, learner, choices: dict[str, list], metric: str, fold: str, folds: int):
    """The learner at the best of all settings, by the mean over the folds, fitted on all rows; and the scores."""
    rows = train.select("label", "features", fold)
    scores, best = nested.cross_validate(rows, learner, choices, metric, fold, folds)
    return nested.refit(rows, learner, best), scores


def filled(train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """The tables with only those places of ``features`` that are not zero throughout ``train``.

    Hashed vectors are mostly empty places; a tree cannot split on them, but keeps a number
    for each of them per row and sums for each per node.
    """
    used = train.select(Summarizer.numNonZeros(F.col("features")).alias("n")).first()["n"].toArray().nonzero()[0].tolist()
    slicer = VectorSlicer(inputCol="_hashed", outputCol="features", indices=used or [0])
    return [slicer.transform(t.withColumnRenamed("features", "_hashed")).drop("_hashed") for t in (train, *others)]


def fitted(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The pipeline fitted on ``rows``, saved and read back, ready to score.

    A fresh two-class model holds its training summary, and that the session.  Spark sends
    both to the tasks, which fails as soon as anything in the session was observed
    (``DataFrame.observe``); a model read back has no summary.
    """
    path = fresh_path(rows.sparkSession, "model")
    pipeline.fit(rows).write().save(path)
    return PipelineModel.load(path)


def text_classifier(n_features: int = 1 << 16, reg: float = 0.01, iterations: int = 30) -> Pipeline:
    """Scores whole texts given as ``words``."""
    return Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="_tf", numFeatures=n_features),
            IDF(inputCol="_tf", outputCol="features"),
            LogisticRegression(regParam=reg, maxIter=iterations),
        ]
    )
