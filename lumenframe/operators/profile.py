"""Table profiling: counts, moments, quantiles, histograms, correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import attach_by_value, average_rank, cut_points, exact_quantiles, running_totals, value_counts


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column in one pass."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def duplicates(df: DataFrame) -> DataFrame:
    """Each row occurring more than once, with its count."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("dupe_count")).where("dupe_count > 1")


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: min, quartiles, mean, max.

    All columns go through one pass in long form; quantiles are exact and computed
    from distinct values, bucket by bucket.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    )
    quarters = exact_quantiles(long, ["column"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    basics = long.groupBy("column").agg(
        F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max")
    )
    return basics.join(quarters, "column")


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: population skewness and Pearson kurtosis (normal = 3)."""
    stats = df.agg(
        *[F.skewness(c).alias(f"s_{c}") for c in columns],
        *[(F.kurtosis(c) + 3).alias(f"k_{c}") for c in columns],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"s_{c}").alias("skew"), F.col(f"k_{c}").alias("kurtosis"))
                for c in columns
            ]
        )
    )
    return stats.select(rows.alias("r")).select("r.*")


def histogram(df: DataFrame, column: str, bins: int = 30, by: list[str] = []) -> DataFrame:
    """Counts per equal-width bin between the column's min and max; the max closes the last bin."""
    span = df.agg(
        F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("s")
    ).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    width = (hi - lo) / bins
    at = F.floor((F.col(column) - lo) / F.nullif(width, F.lit(0.0)))
    binned = df.where(F.col(column).isNotNull()).select(
        *by, F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*by, "bin", (lo + F.col("bin") * width).alias("from_value"), "n")


def boxplot(df: DataFrame, by: str, column: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outlier count per group.

    Works on distinct (group, value) counts, so a hot group costs no more than its
    distinct values, bucket by bucket.
    """
    quarters = exact_quantiles(df, [by], column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    counts = value_counts(df, [by], column)
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    fenced = with_group_facts(counts, quarters, by)
    return fenced.groupBy(by).agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        F.sum("n").alias("n"),
    )


def with_group_facts(rows: DataFrame, facts: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Attach one-row-per-group facts; (key, salt) keeps a hot group spread and a null
    group is a group."""
    salted = rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    )
    copies = facts.select(
        F.col(key).alias("_key"),
        *[c for c in facts.columns if c != key],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"),
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, same).drop("_salt", "_key", "_copy")


def pearson_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for every column pair, all in one aggregate."""
    pairs = list(combinations(columns, 2))
    stats = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                for i, (a, b) in enumerate(pairs)
            ]
        )
    )
    return stats.select(rows.alias("x")).select("x.*")


def spearman_with(df: DataFrame, target: str, features: list[str]) -> DataFrame:
    """(feature, rho): rank correlation of each feature with the target.

    Only the target's ranks are joined back to rows.  For a feature x the sum of
    rank(x) * rank(target) needs just count(x) and sum(rank(target)) per distinct x,
    so every feature is pre-aggregated to its distinct values before any ordering.
    """
    ranks = average_rank(df, [], target).select(target, "n", F.col("avg_rank").alias("_ry"))
    rows = attach_by_value(df.select(target, *features).where(F.col(target).isNotNull()), ranks, target)
    long = rows.select("_ry", *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        ["_ry"], features, "feature", "x"
    )
    sums = (
        long.where(F.col("x").isNotNull())
        .groupBy("feature", "x")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_ry").alias("sy"), F.sum(F.col("_ry") * F.col("_ry")).alias("syy"))
    )
    probe = df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot([], features, "f", "x")
    ranked = running_totals(sums, ["feature"], "x", ["n"], cut_points(probe, "x"))
    mean = (F.col("total_n") + 1) / 2
    rx = F.col("below_n") + (F.col("n") + 1) / 2 - mean
    sy = F.col("sy") - F.col("n") * mean
    grouped = ranked.groupBy("feature").agg(
        F.sum(rx * sy).alias("xy"),
        F.sum(F.col("n") * rx * rx).alias("xx"),
        F.sum(F.col("syy") - 2 * mean * F.col("sy") + F.col("n") * mean * mean).alias("yy"),
    )
    return grouped.select("feature", (F.col("xy") / F.nullif(F.sqrt(F.col("xx") * F.col("yy")), F.lit(0.0))).alias("rho"))


def quantile_edges(df: DataFrame, columns: list[str], buckets: int) -> dict[str, list[float]]:
    """Exact inner edges per column: (columns x buckets) numbers reach the driver."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    probs = {f"p{i}": i / buckets for i in range(1, buckets)}
    rows = exact_quantiles(long, ["column"], "value", probs).collect()
    return {r["column"]: [r[f"p{i}"] for i in range(1, buckets)] for r in rows}


def bucket_of(column: Column, edges: list[float]) -> Column:
    """Number of distinct edges at or below the value: a bucket id from 0."""
    at = F.lit(0)
    for i, e in enumerate(sorted(set(edges)), start=1):
        at = F.when(column >= e, i).otherwise(at)
    return at.cast("double")


def quantile_buckets(df: DataFrame, columns: list[str], buckets: int, suffix: str = "_discretized") -> DataFrame:
    """Replace nothing, add one bucket column per feature."""
    edges = quantile_edges(df, columns, buckets)
    return df.select("*", *[bucket_of(F.col(c), edges[c]).alias(f"{c}{suffix}") for c in columns])
