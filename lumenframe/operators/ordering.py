"""Top-k and best-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per group.  The rank filter is pushed below the shuffle, so a
    hot group sends at most ``k`` rows per task to its window."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(name) <= k)


def best_row(df: DataFrame, columns: list[str], score: Column, keys: list[str] = []) -> DataFrame:
    """Columns of the row with the smallest score (one aggregate, no sort)."""
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), score).alias("_best"))
    return best.select(*keys, "_best.*")
