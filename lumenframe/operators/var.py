"""Vector autoregression of two related daily series."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ols
from .daily import SERIES, along

PAIR = ("y", "y2")


def lag_names(p: int) -> list[str]:
    return [f"{c}_l{i}" for i in range(1, p + 1) for c in PAIR]


def with_lags(daily: DataFrame, p: int) -> DataFrame:
    return daily.select("*", *[F.lag(c, i).over(along()).alias(f"{c}_l{i}") for i in range(1, p + 1) for c in PAIR])


def fit_var(daily: DataFrame, p: int) -> DataFrame:
    """(series_id, equation, const, coef[]) with coefficients ordered as ``lag_names``."""
    fits = ols.fit_choices(with_lags(daily, p), {y: (y, lag_names(p)) for y in PAIR}, [SERIES])
    return fits.select(SERIES, F.col("choice").alias("equation"), "n", F.col("intercept").alias("const"), "coef", "se", "t", "p")


def forecast_fixed(daily: DataFrame, p: int, share: float = 0.2) -> DataFrame:
    """One-step forecasts of the last ``share`` with coefficients from the rows before."""
    whole = Window.partitionBy(SERIES)
    marked = daily.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn(
        "_test", F.row_number().over(along()) > F.col("_n") - F.bround(F.lit(share) * F.col("_n"), 0)
    )
    model = fit_var(marked.where(~F.col("_test")).drop("_n", "_test"), p)
    wide = model.groupBy(SERIES).agg(
        *[F.first(F.when(F.col("equation") == y, F.struct("const", "coef")), True).alias(f"_m_{y}") for y in PAIR]
    )
    # Both sides hold one row per (series, day) at most and are partitioned by series already.
    rows = with_lags(marked, p).where("_test").join(wide, SERIES)
    return rows.select(
        SERIES,
        "t",
        *PAIR,
        *[
            ols.linear(lag_names(p), F.col(f"_m_{y}").getField("coef"), F.col(f"_m_{y}").getField("const")).alias(f"{y}_hat")
            for y in PAIR
        ],
    )


def rmse(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy(SERIES).agg(
        *[F.sqrt(F.avg((F.col(y) - F.col(f"{y}_hat")) * (F.col(y) - F.col(f"{y}_hat")))).alias(f"rmse_{y}") for y in PAIR]
    )


def forecast_rolling(daily: DataFrame, p: int = 2, share: float = 0.2) -> DataFrame:
    """Forecasts with the model refitted on all days before each origin.

    Cross moments are running window sums, so an origin costs one small solve and the
    history is read once.
    """
    whole = Window.partitionBy(SERIES)
    centre = daily.select(
        SERIES,
        "t",
        *[F.avg(c).over(whole).alias(f"_m_{c}") for c in PAIR],
        *[(F.col(c) - F.avg(c).over(whole)).alias(c) for c in PAIR],
        F.count(F.lit(1)).over(whole).alias("_n"),
        F.row_number().over(along()).alias("_i"),
    )
    rows = with_lags(centre, p)
    xs = lag_names(p)
    k = len(xs)
    past = along().rowsBetween(Window.unboundedPreceding, -1)
    full = F.col(xs[-1]).isNotNull()

    def s(expr: Column) -> Column:
        return F.sum(F.when(full, expr)).over(past)

    x = [F.lit(1.0), *[F.col(c) for c in xs]]
    grams = [s(x[i] * x[j]) for i in range(k + 1) for j in range(i, k + 1)]
    crosses = [s(v * F.col(y)) for y in PAIR for v in x]
    sums = rows.select(
        SERIES, "t", "_i", "_n", *PAIR, "_m_y", "_m_y2",
        F.array(*xs).alias("_x"), F.array(*grams).alias("_g"), F.array(*crosses).alias("_h"),
    )
    test = sums.where(F.col("_i") > F.col("_n") - F.bround(F.lit(share) * F.col("_n"), 0)).drop("_i", "_n")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(k + 1)
        for pdf in batches:
            if pdf.empty:
                continue
            flat = np.stack(pdf["_g"].to_numpy()).astype(float)
            gram = np.zeros((len(pdf), k + 1, k + 1))
            gram[:, upper[0], upper[1]] = flat
            gram = gram + np.transpose(np.triu(gram, 1), (0, 2, 1))
            cross = np.stack(pdf["_h"].to_numpy()).astype(float).reshape(len(pdf), 2, k + 1)
            beta = np.einsum("nij,nej->nei", np.linalg.pinv(gram, rcond=1e-13, hermitian=True), cross)
            point = np.column_stack([np.ones(len(pdf)), np.stack(pdf["_x"].to_numpy()).astype(float)])
            hat = np.einsum("nei,ni->ne", beta, point)
            out = {SERIES: pdf[SERIES], "t": pdf["t"]}
            for e, y in enumerate(PAIR):
                out[y] = pdf[y] + pdf[f"_m_{y}"]
                out[f"{y}_hat"] = hat[:, e] + pdf[f"_m_{y}"]
            yield pd.DataFrame(out)

    kind = daily.schema[SERIES].dataType.simpleString()
    return test.mapInPandas(solve, f"{SERIES} {kind}, t date, y double, y_hat double, y2 double, y2_hat double")


def select_order(daily: DataFrame, max_lags: int = 10) -> DataFrame:
    """(series_id, lags, aic, bic, hqic, fpe, reason) on the sample common to all lag counts.

    Lag counts that a series is too short for have nulls and a reason.
    """
    ordered = F.array_sort(F.collect_list(F.struct("t", *PAIR)))
    complete = daily.where(F.col("y").isNotNull() & F.col("y2").isNotNull())
    rows = complete.groupBy(SERIES).agg(ordered.alias("_o")).select(
        SERIES, F.col("_o.y").alias("y"), F.col("_o.y2").alias("y2")
    )
    tasks = rows.withColumn("lags", F.explode(F.sequence(F.lit(0), F.lit(max_lags))))
    parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for series, a, b, p in zip(pdf[SERIES], pdf["y"], pdf["y2"], pdf["lags"]):
                both = np.column_stack([a, b]).astype(float)
                n = len(both) - max_lags
                if n <= 2 * p + 1:
                    out.append((series, int(p), None, None, None, None, "too few days for the lags"))
                    continue
                now = both[max_lags:]
                past = [both[max_lags - i : len(both) - i] for i in range(1, p + 1)]
                x = np.column_stack([np.ones(n), *past])
                rest = now - x @ np.linalg.lstsq(x, now, rcond=None)[0]
                log_det = float(np.linalg.slogdet(rest.T @ rest / n)[1])
                free, used = 4 * p + 2, 2 * p + 1
                out.append(
                    (
                        series,
                        int(p),
                        log_det + 2 / n * free,
                        log_det + math.log(n) / n * free,
                        log_det + 2 * math.log(math.log(n)) / n * free,
                        ((n + used) / (n - used)) ** 2 * math.exp(log_det),
                        None,
                    )
                )
            yield pd.DataFrame(out, columns=[SERIES, "lags", "aic", "bic", "hqic", "fpe", "reason"])

    kind = daily.schema[SERIES].dataType.simpleString()
    return tasks.repartition(parts, SERIES, "lags").mapInPandas(
        score, f"{SERIES} {kind}, lags int, aic double, bic double, hqic double, fpe double, reason string"
    )
