"""Array arithmetic and kernel functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)))


def linear_kernel(a: Column, b: Column) -> Column:
    return dot(a, b)


def poly_kernel(a: Column, b: Column, gamma: float = 1.0, coef0: float = 1.0, degree: int = 2) -> Column:
    return F.pow(F.lit(float(coef0)) + F.lit(float(gamma)) * dot(a, b), F.lit(float(degree)))


def rbf_kernel(a: Column, b: Column, gamma: float = 1.0) -> Column:
    return F.exp(F.lit(-float(gamma)) * squared_distance(a, b))


def sigmoid_kernel(a: Column, b: Column, gamma: float = 1.0, coef0: float = 1.0) -> Column:
    return F.tanh(F.lit(float(gamma)) * dot(a, b) + F.lit(float(coef0)))


def reshape(a: Column, rows: int, width: int) -> Column:
    """Flat array to ``rows`` arrays of ``width``."""
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(a, i * width + 1, width))


def inverse_distances(points: Column) -> Column:
    """Array of (i, j, 1 / distance) for i < j among the points of one record."""
    n = F.size(points)
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: i < n - 1)
    return F.flatten(
        F.transform(
            first,
            lambda i: F.transform(
                F.sequence(i + 1, n - 1),
                lambda j: F.struct(
                    i.alias("i"),
                    j.alias("j"),
                    (1 / F.sqrt(squared_distance(F.get(points, i), F.get(points, j)))).alias("inverse"),
                ),
            ),
        )
    )
