"""Column and row shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut_lineage, lookup


def columns_except(df: DataFrame, *drop: str) -> list[str]:
    return [c for c in df.columns if c not in drop]


def drop_sentinel(df: DataFrame, column: str, code) -> DataFrame:
    """Drop rows whose column holds the missing code; a null is not that code and stays."""
    return df.where(~F.col(column).eqNullSafe(F.lit(code)))


def years_before(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows before the year, as a range on the raw column so that it reaches the scan."""
    return df.where(F.col(ts) < F.lit(f"{year}-01-01").cast(df.schema[ts].dataType))


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    kind = df.schema[ts].dataType
    return df.where(
        (F.col(ts) >= F.lit(f"{year}-01-01").cast(kind)) & (F.col(ts) < F.lit(f"{year + 1}-01-01").cast(kind))
    )


def in_month(df: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    kind = df.schema[ts].dataType
    nxt = (year + month // 12, month % 12 + 1)
    return df.where(
        (F.col(ts) >= F.lit(f"{year}-{month:02d}-01").cast(kind))
        & (F.col(ts) < F.lit(f"{nxt[0]}-{nxt[1]:02d}-01").cast(kind))
    )


def ratio_or_zero(num: Column, den: Column) -> Column:
    """x / y, with 0 where the ratio is missing or infinite."""
    return F.coalesce(num / F.nullif(den, F.lit(0)), F.lit(0.0))


def threshold_flag(col: Column, limit: float) -> Column:
    return F.when(col >= limit, 1).otherwise(0)


def unique_label(title: Column, key: Column) -> Column:
    """Title made unique by a stable key."""
    return F.concat(title, F.lit(" :"), key.cast("string"))


def baseline_shift(df: DataFrame, column: str, out: str) -> DataFrame:
    """Subtract the column's minimum (a scalar subquery, not a join)."""
    return df.withColumn(out, F.col(column) - df.agg(F.min(column)).scalar())


def text_windows(df: DataFrame, column: str, size: int = 800) -> DataFrame:
    """Consecutive windows of ``size`` characters covering the whole text.

    Window 0 is the head a length-limited model would see; the rest is not lost.
    """
    n = F.greatest(F.ceil(F.length(column) / size).cast("int"), F.lit(1))
    at = F.explode(F.sequence(F.lit(0), n - 1)).alias("window")
    cut = df.select("*", at)
    return cut.withColumn("piece", F.substring(F.col(column), F.col("window") * size + 1, F.lit(size)))


def melt(df: DataFrame, keys: list[str], values: list[str], out: str = "value") -> DataFrame:
    """Wide to long without the name column; missing cells are dropped."""
    return df.unpivot(keys, values, "_variable", out).drop("_variable").na.drop(subset=[out])


def levels(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """Distinct values as columns of a wide table; more than ``limit`` are an error, never a cut.

    Only wide forms need their levels on the driver: ``one_hot_long`` and
    ``with_factor_code`` take any number.
    """
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} levels; use the long form")
    return sorted(found)


def one_hot_long(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, level, value): one row per set indicator, for any number of levels.

    A null level has no indicator; a key whose levels are all null gives no row.
    """
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(*keys, F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("value"))


def one_hot(df: DataFrame, column: str, values: list | None = None, prefix: str = "") -> DataFrame:
    """Indicator column per level, per row (no shuffle); a null level sets none."""
    values = levels(df, column) if values is None else values
    return df.select(
        "*", *[F.col(column).eqNullSafe(F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in values]
    )


def multi_hot(df: DataFrame, key: str, item: str, values: list | None = None) -> DataFrame:
    """Count of each item per key, one column per item."""
    values = levels(df, item) if values is None else values
    return df.groupBy(key).agg(
        *[F.count(F.when(F.col(item) == F.lit(v), 1)).alias(str(v)) for v in values]
    )


def with_factor_code(df: DataFrame, column: str, out: str) -> DataFrame:
    """Attach the alphabetical code of a factor, from 1; null for null.

    Codes are places of the distinct values in order: numbered within ranges of values
    that Spark sorts apart, so any number of levels will do, and looked up.
    """
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull()).distinct()
    ranged = cut_lineage(values.repartitionByRange("_value").select("_value", F.spark_partition_id().alias("_range")))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: at most the number of shuffle partitions.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_value"))
    offsets = F.broadcast(sizes.select("_range", before.alias("_before")))
    codes = ranged.join(offsets, "_range").select(F.col("_value").alias(column), (F.col("_before") + inside).cast("int").alias(out))
    return lookup(df, codes, [column], "left").select(*df.columns, out)
