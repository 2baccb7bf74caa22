"""Daily series: one row per (series_id, t) with t a date.

Records are pre-aggregated to days before anything is ordered, so a series holds
at most one row per calendar day however many records it comes from.  All window
and per-series operators rely on that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = "series_id"


def daily_series(df: DataFrame, series: Column, when: Column, **values: Column) -> DataFrame:
    """Aggregate records to (series_id, t, values...); ``when`` may be text, date or timestamp."""
    return df.groupBy(series.alias(SERIES), F.to_date(when).alias("t")).agg(
        *[v.alias(k) for k, v in values.items()]
    )


def fill_calendar(daily: DataFrame, fill: float = 0.0) -> DataFrame:
    """Add the missing days between the first and last day of each series.

    Days that are there stay as they are, nulls included; a null series id is a series.
    """
    span = daily.groupBy(SERIES).agg(F.min("t").alias("_a"), F.max("t").alias("_b"))
    days = span.select(F.col(SERIES).alias("_series"), F.explode(F.sequence("_a", "_b")).alias("_day"))
    rows = daily.withColumn("_there", F.lit(True))
    joined = days.join(rows, F.col("_series").eqNullSafe(F.col(SERIES)) & (F.col("_day") == F.col("t")), "left")
    kinds = dict(daily.dtypes)
    values = [c for c in daily.columns if c not in (SERIES, "t")]
    return joined.select(
        F.col("_series").alias(SERIES), F.col("_day").alias("t"),
        *[F.when(F.col("_there"), F.col(c)).otherwise(F.lit(fill).cast(kinds[c])).alias(c) for c in values],
    )


def along() -> Window:
    return Window.partitionBy(SERIES).orderBy("t")


def position() -> Column:
    return F.row_number().over(along())


def length() -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(SERIES))


def lagged(daily: DataFrame, column: str, lags: int, prefix: str = "lag") -> DataFrame:
    """Columns lag1..lagk in one window pass."""
    return daily.select("*", *[F.lag(column, i).over(along()).alias(f"{prefix}{i}") for i in range(1, lags + 1)])


def lag_table(daily: DataFrame, column: str, lags: int = 1) -> DataFrame:
    """Supervised rows: the value and its ``lags`` predecessors, gaps filled with 0."""
    return lagged(daily, column, lags, "x").na.fill(0.0, [f"x{i}" for i in range(1, lags + 1)])


def pct_change(daily: DataFrame, column: str, out: str) -> DataFrame:
    """100 * (y_t / y_{t-1} - 1); the first row of each series goes."""
    before = F.lag(column).over(along())
    first = F.row_number().over(along()) == 1
    changed = daily.withColumn("_first", first).withColumn(
        out, 100 * (F.col(column) / F.nullif(before, F.lit(0.0)) - 1)
    )
    return changed.where(~F.col("_first")).drop("_first")


def chrono_split(daily: DataFrame, share: float = 0.8) -> DataFrame:
    """``part`` = train for the first round(share * n) rows (half to even), else test."""
    cut = F.bround(F.lit(share) * length(), 0)
    return daily.withColumn("part", F.when(position() <= cut, "train").otherwise("test"))


def expanding_ar1(daily: DataFrame, column: str) -> DataFrame:
    """For every day, the regression of y on its predecessor over all earlier pairs,
    and the forecast it gives.  One running window; no refit per origin."""
    centre = F.avg(column).over(Window.partitionBy(SERIES))
    pairs = daily.select(SERIES, "t", column, centre.alias("_m")).withColumn(
        "_x", F.lag(column).over(along()) - F.col("_m")
    )
    pairs = pairs.withColumn("_y", F.col(column) - F.col("_m"))
    past = along().rowsBetween(Window.unboundedPreceding, -1)
    seen = F.col("_x").isNotNull()

    def s(expr: Column) -> Column:
        return F.sum(F.when(seen, expr)).over(past)

    x, y = F.col("_x"), F.col("_y")
    sums = pairs.select(
        "*",
        s(F.lit(1)).alias("_n"),
        s(x).alias("_sx"),
        s(y).alias("_sy"),
        s(x * y).alias("_sxy"),
        s(x * x).alias("_sxx"),
    )
    n, sx, sy = F.col("_n"), F.col("_sx"), F.col("_sy")
    spread = n * F.col("_sxx") - sx * sx
    slope = (n * F.col("_sxy") - sx * sy) / F.nullif(F.when(n > 1, spread), F.lit(0.0))
    fitted = sums.withColumn("slope", slope).withColumn("_c", (sy - F.col("slope") * sx) / n)
    return fitted.select(
        SERIES,
        "t",
        column,
        F.col("_n").alias("pairs"),
        "slope",
        (F.col("_c") + F.col("slope") * x + F.col("_m")).alias("forecast"),
    )
