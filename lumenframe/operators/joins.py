"""Lookups, positional alignment, pairwise values within a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .ranking import ordinal


def positional_attach(
    left: DataFrame, right: DataFrame, left_order: str, right_order: str, keys: list[str] = []
) -> DataFrame:
    """Row i of ``left`` with row i of ``right``; both orders must be unique per key."""
    a = ordinal(left, keys, left_order, "_at").drop("_at_total")
    b = ordinal(right, keys, right_order, "_at").drop("_at_total")
    return a.join(b, [*keys, "_at"]).withColumnRenamed("_at", "position")


def record_pairs(df: DataFrame, key: str, points: Column) -> DataFrame:
    """(key, i, j, inverse) for all point pairs i < j inside one record."""
    return df.select(key, F.explode(V.inverse_distances(points)).alias("_p")).select(key, "_p.*")


def inverse_distance_descriptor(df: DataFrame, key: str, points: Column) -> DataFrame:
    """(key, descriptor): inverse distances ordered by (i, j), built inside the row."""
    return df.select(key, V.inverse_distances(points).getField("inverse").alias("descriptor"))


def pick_landmarks(df: DataFrame, key: str, vector: str, m: int) -> DataFrame:
    """``m`` rows by smallest hash of the key: a repeatable sample of bounded size."""
    return df.select(key, vector).orderBy(F.md5(F.col(key).cast("string")), key).limit(m)


def kernel_values(
    df: DataFrame, key: str, vector: str, landmarks: DataFrame, gamma: float, coef0: float, degree: int
) -> DataFrame:
    """(key, landmark, four kernels) of each row against a bounded set of landmarks.

    The landmarks travel as one array value (a scalar subquery over ``m`` rows).
    """
    marks = landmarks.agg(
        F.collect_list(F.struct(F.col(key).alias("landmark"), F.col(vector).alias("v")))
    ).scalar()
    each = df.select(key, F.col(vector).alias("_x"), F.explode(marks).alias("_l"))
    x, v = F.col("_x"), F.col("_l.v")
    return each.select(
        key,
        F.col("_l.landmark").alias("landmark"),
        V.linear_kernel(x, v).alias("linear"),
        V.poly_kernel(x, v, gamma, coef0, degree).alias("poly"),
        V.rbf_kernel(x, v, gamma).alias("rbf"),
        V.sigmoid_kernel(x, v, gamma, coef0).alias("sigmoid"),
    )
