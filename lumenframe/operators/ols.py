"""Least squares from moments.

One distributed aggregate builds means and co-moments (stable, mergeable, so hot
groups are combined before the shuffle); only the k x k system of each group is
solved in Python, one row per group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.special import student_two_sided


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


# Up to this many columns each co-moment is its own built-in aggregate; a generated
# aggregate of dozens of them gets too large to compile well, so beyond it each task
# sums its rows with one matrix product per group.
NARROW = 4


def moments(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, n, mean[], comoment[]) with population co-moments of the upper triangle.

    Rows with a missing value in any of the columns are left out, as in any regression.
    """
    k = len(columns)
    names = [f"_c{i}" for i in range(k)]
    doubles = [F.col(c).cast("double").alias(n) for c, n in zip(columns, names)]
    rows = df.select(*keys, *doubles).na.drop(subset=names)
    if k > NARROW:
        return _wide_moments(rows, keys, names)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(n) for n in names]).alias("mean"),
        F.array(*[F.covar_pop(names[i], names[j]) for i, j in _pairs(k)]).alias("comoment"),
    )


# Groups a task holds before it hands them on.
HELD_GROUPS = 10_000


def _wide_moments(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One pass: rows -> partials per (task, group) -> merged on (group, salt) -> merged per group.

    A task never holds more than ``HELD_GROUPS`` groups: it hands on what it has and starts
    again, and the last step closes a group when its sorted key has passed.
    """
    upper = np.triu_indices(len(names))
    schema = T.StructType([
        *[rows.schema[c] for c in keys], *T.StructType.fromDDL("n bigint, mean array<double>, comoment array<double>").fields
    ])
    columns = schema.names

    def groups(pdf: pd.DataFrame) -> Iterator[tuple[tuple, np.ndarray]]:
        if not keys:
            yield (), np.arange(len(pdf))
        else:
            for key, at in pdf.groupby(keys, dropna=False, sort=False).indices.items():
                yield (key if isinstance(key, tuple) else (key,)), at

    def table(found: dict) -> pd.DataFrame:
        out = [(*key, n, list(mean), list(spread / n)) for key, (n, mean, spread) in found.items()]
        return pd.DataFrame(out, columns=columns)

    def add(found: dict, key: tuple, n: float, mean: np.ndarray, spread: np.ndarray) -> None:
        """Merge of two disjoint groups around their joint mean."""
        if key in found:
            m, centre, base = found[key]
            gap = mean - centre
            both = m + n
            spread = spread + base + np.outer(gap, gap)[upper] * (m * n / both)
            n, mean = both, centre + gap * (n / both)
        found[key] = (n, mean, spread)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict = {}
        for pdf in batches:
            x = pdf[names].to_numpy(float)
            for key, at in groups(pdf):
                if len(at):
                    mean = x[at].mean(0)
                    d = x[at] - mean
                    add(found, key, len(at), mean, (d.T @ d)[upper])
            if len(found) > HELD_GROUPS:
                yield table(found)
                found = {}
        yield table(found)

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key: only the last key of a batch may go on in the next."""
        found: dict = {}
        key_of: dict = {}
        for pdf in batches:
            last = None
            for key, at in groups(pdf):
                name = tuple(None if k != k else k for k in key)  # a missing part equals itself
                key_of[name] = key
                for i in at:
                    n, mean, spread = pdf["n"].iat[i], pdf["mean"].iat[i], pdf["comoment"].iat[i]
                    add(found, name, n, np.asarray(mean), np.asarray(spread) * n)
                if at[-1] == len(pdf) - 1:
                    last = name
            yield table({key_of.pop(f): found.pop(f) for f in [f for f in found if f != last]})
        yield table({key_of[f]: v for f, v in found.items()})

    def by_key(table: DataFrame) -> DataFrame:
        return table.sortWithinPartitions(*keys) if keys else table

    parts = rows.mapInPandas(partial, schema).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    fewer = by_key(parts.repartition(*keys, "_salt").drop("_salt")).mapInPandas(merged, schema)
    # At most 64 partials per group are left.
    whole = fewer.repartition(*keys) if keys else fewer.repartition(1)
    return by_key(whole).mapInPandas(merged, schema)


def _square(tri: np.ndarray, k: int) -> np.ndarray:
    full = np.zeros((k, k))
    rows, cols = np.triu_indices(k)
    full[rows, cols] = tri
    return full + np.triu(full, 1).T


def solve_centred(cov: np.ndarray, ridge: float = 0.0) -> tuple[np.ndarray, np.ndarray, int]:
    """Slopes of the last variable on the others, inverse of the predictor block, and rank.

    Predictors are scaled to unit variance first; directions without variance get 0,
    as when a collinear column is dropped.
    """
    k = cov.shape[0] - 1
    a, b = cov[:k, :k], cov[:k, k]
    scale = np.sqrt(np.clip(np.diag(a), 0, None))
    scale[scale == 0] = 1.0
    scaled = a / np.outer(scale, scale) + ridge * np.eye(k)
    values, vectors = np.linalg.eigh(scaled)
    keep = values > max(values.max(initial=0.0), 1e-300) * k * 1e-13
    inverse = (vectors[:, keep] / values[keep]) @ vectors[:, keep].T
    inverse = inverse / np.outer(scale, scale)
    return inverse @ b, inverse, int(keep.sum())


FIT_FIELDS = (
    "n bigint, intercept double, coef array<double>, se array<double>, t array<double>, p array<double>, "
    "r2 double, r2adj double, sigma double"
)


def fit(df: DataFrame, y: str, xs: list[str], keys: list[str] = [], ridge: float = 0.0) -> DataFrame:
    """Grouped OLS: one row per group with coefficients, their standard errors
    (intercept last), R2, adjusted R2 and residual deviation."""
    return fit_choices(df, {"": (y, xs)}, keys, ridge).drop("choice")


def fit_choices(
    df: DataFrame, choices: dict[str, tuple[str, list[str]]], keys: list[str] = [], ridge: float = 0.0
) -> DataFrame:
    """Several regressions from one pass: a row per group and choice (target, predictors).

    The moments of all columns used hold those of every choice, so the rows are read once.
    A row that misses any of the columns is left out of all choices, which makes them
    comparable.
    """
    columns = list(dict.fromkeys(c for y, xs in choices.values() for c in (*xs, y)))
    found = moments(df, keys, columns)
    found = found.withColumn("choice", F.explode(F.array(*[F.lit(c) for c in choices])))
    places = {c: [columns.index(x) for x in (*xs, y)] for c, (y, xs) in choices.items()}

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                at = places[r.choice]
                k = len(at) - 1
                n, mean = int(r.n), np.asarray(r.mean, float)[at]
                cov = _square(np.asarray(r.comoment, float), len(columns))[np.ix_(at, at)]
                beta, inverse, rank = solve_centred(cov, ridge)
                sst = n * cov[k, k]
                sse = max(n * (cov[k, k] - beta @ cov[:k, k] * 2 + beta @ cov[:k, :k] @ beta), 0.0)
                free = n - rank - 1
                r2 = 1 - sse / sst if sst > 0 else None
                s2 = sse / free if free > 0 else np.nan
                spread = np.append(np.diag(inverse) / n, 1 / n + mean[:k] @ inverse @ mean[:k] / n)
                se = np.sqrt(np.clip(s2 * spread, 0, None))
                both = np.append(beta, mean[k] - beta @ mean[:k])
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = both / se
                p = student_two_sided(t, free) if free > 0 else np.full(k + 1, np.nan)
                adj = 1 - (1 - r2) * (n - 1) / free if r2 is not None and free > 0 else None
                rows.append((n, both[k], list(beta), list(se), list(t), list(p), r2, adj, float(np.sqrt(s2))))
            names = ["n", "intercept", "coef", "se", "t", "p", "r2", "r2adj", "sigma"]
            out = pd.DataFrame(rows, columns=names)
            yield pd.concat([pdf[[*keys, "choice"]].reset_index(drop=True), out], axis=1)[[*keys, "choice", *names]]

    schema = T.StructType([*[found.schema[c] for c in (*keys, "choice")], *T.StructType.fromDDL(FIT_FIELDS).fields])
    return found.mapInPandas(solve, schema)


def linear(xs: list[str], coef: Column, intercept: Column) -> Column:
    out = intercept
    for i, x in enumerate(xs):
        out = out + F.get(coef, F.lit(i)) * F.col(x).cast("double")
    return out


def predict(df: DataFrame, model: DataFrame, xs: list[str], out: str = "prediction") -> DataFrame:
    """Apply a one-row model as a scalar subquery (no join)."""
    m = model.select(F.struct("intercept", "coef")).scalar()
    return df.withColumn(out, linear(xs, m.getField("coef"), m.getField("intercept")))


def predict_grouped(
    df: DataFrame, model: DataFrame, xs: list[str], keys: list[str], out: str = "prediction", salts: int = 16
) -> DataFrame:
    """Apply one model per group; rows of a hot group are spread over salts."""
    copies = model.select(
        *[F.col(c).alias(f"_k_{c}") for c in keys],
        F.col("intercept").alias("_i"),
        F.col("coef").alias("_c"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"),
    )
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in xs]), F.lit(salts)).cast("int"))
    same = F.col("_salt") == F.col("_copy")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = salted.join(copies, same)
    spare = ["_salt", "_copy", "_i", "_c", *[f"_k_{c}" for c in keys]]
    return joined.withColumn(out, linear(xs, F.col("_c"), F.col("_i"))).drop(*spare)
