"""Frequent itemsets and association rules with consequents of any size."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage


def frequent_itemsets(baskets: DataFrame, items: str = "items", min_support: float = 0.1) -> DataFrame:
    """(items[], freq, support) with sorted items; repeated items in a basket count once."""
    sets = baskets.select(F.array_distinct(items).alias("items")).where(F.size("items") > 0)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(sets)
    # Empty baskets are baskets too: support is over all of them.
    total = baskets.select(F.lit(1).alias("_one")).agg(F.count(F.lit(1))).scalar()
    found = model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / total).alias("support")
    )
    return found.where(F.col("support") >= min_support)


def association_rules(itemsets: DataFrame, min_confidence: float = 0.95) -> DataFrame:
    """(lhs[], rhs[], support, confidence, lift) for every split of every frequent itemset.

    All subsets of a frequent itemset are frequent and in the table already, so the
    splits cannot outgrow what mining had to produce anyway.
    """
    itemsets = cut_lineage(itemsets)  # used three times, and mined anew each time otherwise
    splits = itemsets.where(F.size("items") >= 2).select(
        "items",
        "support",
        F.explode(
            F.sequence(F.lit(1).cast("bigint"), F.expr("shiftleft(1L, size(items))") - 2)
        ).alias("_mask"),
    )
    rules = splits.select(
        F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1L) = 1L)").alias("lhs"),
        F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1L) = 0L)").alias("rhs"),
        "support",
    )
    left = itemsets.select(F.col("items").alias("lhs"), F.col("support").alias("_left"))
    right = itemsets.select(F.col("items").alias("rhs"), F.col("support").alias("_right"))
    sure = rules.join(left, "lhs").withColumn("confidence", F.col("support") / F.col("_left"))
    kept = sure.where(F.col("confidence") >= min_confidence).join(right, "rhs")
    return kept.select(
        "lhs", "rhs", "support", "confidence", (F.col("confidence") / F.col("_right")).alias("lift")
    )
