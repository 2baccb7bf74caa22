"""Feature preparation: fitted on training rows, applied to any rows."""

from __future__ import annotations

from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_share(key: Column, seed: int = 12345) -> Column:
    """Repeatable uniform number in [0, 1) from a key; independent of partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def with_split(df: DataFrame, key: str | list[str], share: float = 0.8, seed: int = 12345, out: str = "part") -> DataFrame:
    """``part`` = train or test for every row."""
    keys = [key] if isinstance(key, str) else key
    mark = split_share(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), seed)
    return df.withColumn(out, F.when(mark < share, "train").otherwise("test"))


def with_fold(df: DataFrame, key: str | list[str], folds: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Repeatable fold id from 0."""
    keys = [key] if isinstance(key, str) else key
    mark = split_share(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), seed)
    return df.withColumn(out, F.floor(mark * folds).cast("int"))


def assemble(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="error").transform(df)


def label_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """Index by descending frequency, ties alphabetical."""
    return StringIndexer(inputCol=column, outputCol=out, stringOrderType="frequencyDesc").fit(df).transform(df)


def standardize(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    base = df if fit_on is None else fit_on
    stats = base.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"d_{c}") for c in columns]
        ).alias("s")
    ).scalar()

    def z(c: str) -> Column:
        scale = F.coalesce(F.nullif(stats.getField(f"d_{c}"), F.lit(0.0)), F.lit(1.0))
        return (F.col(c) - stats.getField(f"m_{c}")) / scale

    return df.withColumns({c: z(c) for c in columns})


def range_scale(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Min-max to [0, 1] with the limits of ``fit_on`` (usually the training rows)."""
    base = df if fit_on is None else fit_on
    stats = base.agg(
        F.struct(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).alias("s")
    ).scalar()

    def scaled(c: str) -> Column:
        lo, hi = stats.getField(f"lo_{c}"), stats.getField(f"hi_{c}")
        return F.coalesce((F.col(c) - lo) / F.nullif(hi - lo, F.lit(0)), F.lit(0.0))

    return df.withColumns({c: scaled(c) for c in columns})


def treatment_coding(df: DataFrame, formula: str, fit_on: DataFrame | None = None) -> DataFrame:
    """Factors to dummies with the first alphabetical level as the base."""
    coder = RFormula(formula=formula, stringIndexerOrderType="alphabetDesc")
    return coder.fit(df if fit_on is None else fit_on).transform(df)


def dummy_names(levels: dict[str, list]) -> list[str]:
    """``factor_level`` for every level but the first."""
    return [f"{c}_{v}" for c, values in levels.items() for v in sorted(values)[1:]]


def dummies(levels: dict[str, list]) -> dict[str, Column]:
    """Indicator columns under those names; 0 for null."""
    cells = [(c, v) for c, values in levels.items() for v in sorted(values)[1:]]
    return {n: F.col(c).eqNullSafe(F.lit(v)).cast("double") for n, (c, v) in zip(dummy_names(levels), cells)}


def interactions(pairs: list[tuple[str, str]]) -> dict[str, Column]:
    return {f"{a}:{b}": F.col(a).cast("double") * F.col(b).cast("double") for a, b in pairs}


def polynomial_terms(df: DataFrame, column: str, degree: int) -> DataFrame:
    """Powers of the centred column: the same fit as orthogonal polynomials."""
    centre = F.col(column) - df.agg(F.avg(column)).scalar()
    return df.withColumns({f"{column}_{p}": F.pow(centre, F.lit(float(p))) for p in range(1, degree + 1)})
