"""Connected components by alternating star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage


def _star(edges: DataFrame, downward: bool) -> DataFrame:
    """One step: hang the neighbours of each node below the smallest of them.

    ``downward`` keeps the neighbours under a node and the node itself, otherwise those
    above it.  The smallest neighbour is an aggregate that combines before the shuffle and
    is joined back, so no neighbourhood is ever gathered in one place.
    """
    both = edges if downward else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if downward:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    else:
        hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def roots(edges: DataFrame) -> DataFrame:
    """(a, root) for every node that has an edge to a smaller node of its component.

    ``edges`` has long columns ``a`` and ``b``.  Each round is written to the shared
    folder; rounds go on until the edge table stays as it is, about the logarithm of the
    longest chain.
    """
    current = cut_lineage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = _mark(current)
    while mark[0]:
        current = cut_lineage(_star(_star(current, downward=False), downward=True))
        after = _mark(current)
        if after == mark:
            break
        mark = after
    return current.select("a", F.col("b").alias("root"))
