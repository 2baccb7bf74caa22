"""Evaluation of predictions held in the same row as the truth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frame import levels
from .ranking import running_totals


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): one row per occurring cell."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Label rows, one ``pred_*`` column per predicted level."""
    cells = confusion(df, label, prediction)
    values = levels(cells, "prediction")
    return cells.groupBy("label").agg(
        *[F.sum(F.when(F.col("prediction") == F.lit(v), F.col("n")).otherwise(0)).alias(f"pred_{v}") for v in values]
    )


def accuracy(cells: DataFrame) -> DataFrame:
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.agg((hit / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))


def by_label(cells: DataFrame) -> DataFrame:
    """Per label: support, precision, recall, false positive rate, F1.

    Starts from the confusion cells, so it never touches the rows again.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.explode(
        F.array(
            F.struct(F.col("label").alias("of"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("called"), hit.alias("tp")),
            F.struct(F.col("prediction").alias("of"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")),
        )
    ).alias("s")
    per = cells.select(sides).groupBy(F.col("s.of").alias("label")).agg(
        F.sum("s.actual").alias("actual"), F.sum("s.called").alias("called"), F.sum("s.tp").alias("tp")
    )
    total = cells.agg(F.sum("n")).scalar()
    tp, actual, called = F.col("tp"), F.col("actual"), F.col("called")

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0).cast("bigint")), F.lit(0.0))

    return per.select(
        "label",
        actual.alias("support"),
        share(tp, called).alias("precision"),
        share(tp, actual).alias("recall"),
        share(called - tp, total - actual).alias("false_positive_rate"),
        share(2 * tp, actual + called).alias("f1"),
    )


def weighted_f1(cells: DataFrame) -> DataFrame:
    """F1 weighted by support: the default tuning metric for several classes."""
    per = by_label(cells)
    return per.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def _score_counts(df: DataFrame, score: str, positive: Column) -> DataFrame:
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(positive.cast("int")).alias("pos")
    )


def threshold_curve(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """Precision and recall when everything scoring at or above the threshold is positive."""
    ranked = running_totals(_score_counts(df, score, positive), [], "score", ["n", "pos"])
    called = F.col("total_n") - F.col("below_n")
    tp = F.col("total_pos") - F.col("below_pos")
    return ranked.select(
        F.col("score").alias("threshold"),
        called.alias("called"),
        tp.alias("tp"),
        (tp / called).alias("precision"),
        (tp / F.nullif(F.col("total_pos"), F.lit(0).cast("bigint"))).alias("recall"),
    )


def area_under_roc(df: DataFrame | None, score: str, positive: Column | None, by: list[str] = [], counts: DataFrame | None = None) -> DataFrame:
    """Exact area from average ranks of the positives; no threshold binning.

    ``counts`` (by, score, n, pos) may be given in place of rows.
    """
    counts = _score_counts(df, score, positive) if counts is None else counts
    ranked = running_totals(counts, by, "score", ["n", "pos"])
    rank = F.col("below_n") + (F.col("n") + 1) / 2
    sums = ranked.groupBy(*by).agg(
        F.sum(F.col("pos") * rank).alias("r"),
        F.sum("pos").cast("double").alias("p"),
        F.sum(F.col("n") - F.col("pos")).cast("double").alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    return sums.select(*by, ((F.col("r") - p * (p + 1) / 2) / F.nullif(p * q, F.lit(0.0))).alias("auc"))


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: list[str] = []) -> DataFrame:
    """MAE, MSE, RMSE and R2 = 1 - SSE / SST, one pass."""
    error = F.col(truth) - F.col(predicted)
    stats = df.groupBy(*by).agg(
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.when(error.isNotNull(), F.col(truth))).alias("_v"),
    )
    return stats.select(
        *by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.nullif(F.col("_v"), F.lit(0.0))).alias("r2")
    )


def rating_agreement(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    gap = (F.col(truth) - F.col(predicted)).cast("double")
    return df.agg(
        (100 * F.avg((gap == 0).cast("int"))).alias("accuracy_pct"),
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
    )


def compare_models(scored: dict[str, DataFrame], truth: str, predicted: str = "prediction") -> DataFrame:
    """One metrics row per model, ordered by R2."""
    rows = [
        regression_metrics(df, truth, predicted).select(F.lit(name).alias("model"), "mae", "rmse", "r2")
        for name, df in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("r2", "model")
