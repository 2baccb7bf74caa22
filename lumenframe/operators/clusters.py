"""Clustering features on a grid, and global clusters over them.

A cell of side 2 * threshold / sqrt(d) keeps every subcluster's radius at or under
the threshold.  Points are summed into cells with map-side combine; everything
after works on cells.
"""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup


def cell_columns(columns: list[str], threshold: float) -> list[Column]:
    side = 2 * threshold / math.sqrt(len(columns))
    return [F.floor(F.col(c) / side).cast("bigint").alias(f"cell_{i}") for i, c in enumerate(columns, 1)]


def cell_names(columns: list[str]) -> list[str]:
    return [f"cell_{i}" for i in range(1, len(columns) + 1)]


def subclusters(points: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """(cells, n, centroid columns, radius) of each occupied cell."""
    placed = points.select("*", *cell_columns(columns, threshold))
    return placed.groupBy(*cell_names(columns)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(c) for c in columns],
        F.sqrt(sum((F.var_pop(c) for c in columns), F.lit(0.0))).alias("radius"),
    )


def global_clusters(cells: DataFrame, columns: list[str], k: int = 100, seed: int = 0) -> DataFrame:
    """Add ``cluster`` to the cells: weighted k-means on their centroids."""
    # Cells are read by every iteration and again for the labels, so they are written once.
    written = cut_lineage(cells.withColumn("_w", F.col("n").cast("double")))
    rows = VectorAssembler(inputCols=columns, outputCol="_x").transform(written)
    fewer = min(k, rows.limit(k).count())
    model = KMeans(
        k=max(fewer, 2), seed=seed, featuresCol="_x", weightCol="_w", predictionCol="cluster"
    ).fit(rows)
    return model.transform(rows).drop("_x", "_w")


def label_points(points: DataFrame, cells: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """Give every point the cluster of its cell; hot cells are spread."""
    names = cell_names(columns)
    placed = points.select("*", *cell_columns(columns, threshold))
    return lookup(placed, cells.select(*names, "cluster"), names).drop(*names)


def cluster_counts(cells: DataFrame, cluster: str | None = None) -> DataFrame:
    """(clusters, points, largest); from the cells, without touching the points again."""
    sizes = cells if cluster is None else cells.groupBy(cluster).agg(F.sum("n").alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("points"), F.max("n").alias("largest")
    )
