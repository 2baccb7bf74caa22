"""Order statistics over whole tables and hot groups without a one-task window.

The idea used everywhere below: cut the value axis at approximate quantiles, so
that every (group, bucket) holds a small share of the rows however large the
group is; sum per bucket; turn the tiny bucket table into offsets; and run the
window only inside (group, bucket).  Results are exact: the cut points only
balance the work.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def default_buckets(df: DataFrame) -> int:
    """A few buckets per shuffle task: with tasks sized for the data, so are the buckets."""
    return max(32, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def as_number(df: DataFrame, value: str) -> Column:
    """Monotone double for balancing; equal values give equal numbers."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(value).cast("timestamp").cast("double")
    return F.col(value).cast("double")


def cut_points(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Approximate quantiles of ``value``; at most ``buckets`` numbers reach the driver."""
    buckets = buckets or default_buckets(df)
    probs = [i / buckets for i in range(1, buckets)]
    probe = df.select(as_number(df, value).alias("v"))
    found = probe.approxQuantile("v", probs, 1 / (2 * buckets))
    inner = sorted({v for v in found if not math.isnan(v) and not math.isinf(v)})
    return [float("-inf"), *(inner or [0.0]), float("inf")]


def running_totals(
    df: DataFrame,
    keys: list[str],
    value: str,
    measures: list[str],
    splits: list[float] | None = None,
) -> DataFrame:
    """Add ``below_<m>`` (sum over smaller values in the group) and ``total_<m>``.

    ``(keys, value)`` must be unique in ``df``: aggregate first, or pass a unique
    order column.  Rows with a null or NaN value are not ranked and not returned.
    """
    splits = splits or cut_points(df, value)
    number = as_number(df, value)
    ranked = df.where(F.col(value).isNotNull() & ~F.isnan(number)).withColumn("_v", number)
    ranked = Bucketizer(splits=splits, inputCol="_v", outputCol="_b").transform(ranked).drop("_v")

    per_bucket = ranked.groupBy(*keys, "_b").agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    # One row per (group, bucket): bounded by the number of buckets within a group.
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_b").alias("_kb"),
        *[F.coalesce(F.sum(f"_s_{m}").over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"total_{m}") for m in measures],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_b") == F.col("_kb")]
    inside = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = ranked.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_in_{m}") for m in measures]
    ).join(offsets, reduce(lambda a, b: a & b, same))
    return out.select(
        *df.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"below_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with their counts: hot values collapse before any sort."""
    return (
        df.where(F.col(value).isNotNull() & ~F.isnan(as_number(df, value)))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles per group; ``probs`` maps output name to probability."""
    counts = value_counts(df, keys, value)  # one shuffle, used for the totals and for the ranks
    ranked = running_totals(counts, keys, value, ["n"], cut_points(df, value))
    lo_hi, out = [], []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("total_n") - 1)
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("below_n") <= at) & (at < F.col("below_n") + F.col("n"))
            lo_hi.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
        frac = pos - F.floor(pos)
        out.append(
            (F.col(f"_lo_{name}") + frac * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name)
        )
    grouped = ranked.groupBy(*keys).agg(*lo_hi, F.max("total_n").alias("total_n"))
    return grouped.select(*keys, *out)


def average_rank(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, avg_rank): tied values share the mean of their ranks, from 1."""
    ranked = running_totals(value_counts(df, keys, value), keys, value, ["n"], cut_points(df, value))
    return ranked.withColumn("avg_rank", F.col("below_n") + (F.col("n") + 1) / 2)


def attach_by_value(df: DataFrame, facts: DataFrame, value: str, parts: int = 64) -> DataFrame:
    """Inner join ``facts`` (unique by ``value``, with its row count ``n``) back to rows.

    Values holding more than 1/parts of the rows number fewer than ``parts``; their
    facts are copied under ``parts`` salts and their rows spread, so no task gets
    more than a bounded share of a hot value.
    """
    total = facts.agg(F.sum("n")).scalar()
    flagged = facts.withColumn("_hot", F.col("n") * parts > total)
    hot = F.broadcast(flagged.where("_hot").select(value, "_hot"))  # fewer than `parts` rows
    spread_rows = df.join(hot, value, "left").withColumn(
        "_salt",
        F.when(
            F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(parts))
        ).otherwise(F.lit(0)).cast("int"),
    ).drop("_hot")
    copies = F.when(F.col("_hot"), F.lit(parts - 1)).otherwise(F.lit(0))
    spread_facts = flagged.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies))).drop("_hot", "n")
    return spread_rows.join(spread_facts, [value, "_salt"]).drop("_salt")


def ordinal(df: DataFrame, keys: list[str], order: str, name: str = "ordinal") -> DataFrame:
    """Row position from 0 within the group; ``order`` must be unique in the group."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, ["_one"])
    return ranked.withColumnsRenamed({"below__one": name, "total__one": f"{name}_total"}).drop("_one")
