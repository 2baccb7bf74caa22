"""Autocorrelation and the tests run on a series, for many series at once.

Input is a daily series (one row per series_id and date), so one series never
exceeds the days of the calendar; see ``daily``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import chi2_tail, f_tail, normal_cdf
from .daily import SERIES, along
from .ols import _square, moments, solve_centred


def acf(daily: DataFrame, column: str, lags: int = 10) -> DataFrame:
    """(series_id, lag, acf, n): full-sample mean, divisor n; one window pass."""
    whole = Window.partitionBy(SERIES)
    centred = daily.where(F.col(column).isNotNull()).select(
        SERIES, "t", (F.col(column) - F.avg(column).over(whole)).alias("_d")
    )
    shifted = centred.select(SERIES, "_d", *[F.lag("_d", k).over(along()).alias(f"_d{k}") for k in range(1, lags + 1)])
    sums = shifted.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.coalesce(F.sum(F.col("_d") * F.col(f"_d{k}")), F.lit(0.0)).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    each = F.posexplode(F.array(*[F.col(f"_s{k}") / F.nullif(F.col("_s0"), F.lit(0.0)) for k in range(lags + 1)]))
    return sums.select(SERIES, "n", each.alias("lag", "acf"))


def _acf_rows(daily: DataFrame, column: str, lags: int) -> DataFrame:
    """(series_id, n, r[]): the ``lags + 1`` autocorrelations of a series in one row."""
    found = acf(daily, column, lags)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x.acf)
    return found.groupBy(SERIES).agg(F.first("n").alias("n"), ordered.alias("r"))


def pacf(daily: DataFrame, column: str, lags: int = 10) -> DataFrame:
    """(series_id, lag, pacf) by the Durbin-Levinson recursion on the autocorrelations."""

    def recurse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for series, r in zip(pdf[SERIES], pdf["r"]):
                r = np.asarray(r, float)
                phi = np.zeros(0)
                rows.append((series, 0, 1.0))
                for k in range(1, len(r)):
                    left = 1 - phi @ r[1:k] if k > 1 else 1.0
                    last = (r[k] - phi @ r[1:k][::-1]) / left
                    phi = np.append(phi - last * phi[::-1], last)
                    rows.append((series, k, float(last)))
            yield pd.DataFrame(rows, columns=[SERIES, "lag", "pacf"])

    found = _acf_rows(daily, column, lags)
    kind = daily.schema[SERIES].dataType.simpleString()
    return found.select(SERIES, "r").mapInPandas(recurse, f"{SERIES} {kind}, lag int, pacf double")


# MacKinnon's published response surfaces for one series with a constant.
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def adf_p_value(stat: float) -> float:
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    surface = ADF_SMALL_P if stat <= ADF_STAR else ADF_LARGE_P
    return normal_cdf(sum(c * stat**i for i, c in enumerate(surface)))


def adf_test(daily: DataFrame, column: str, max_lags: int = 5) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant; lag count by AIC.

    Every lag count 0..max gets its moments over its own sample from one aggregate.
    The longest model's moments also contain every shorter model on the common
    sample, which is what the AIC comparison needs.
    """
    before = F.lag(column).over(along())
    steps = daily.where(F.col(column).isNotNull()).select(
        SERIES, "t", before.alias("_x0"), (F.col(column) - before).alias("_y")
    )
    lagged = steps.select(SERIES, "_y", "_x0", *[F.lag("_y", i).over(along()).alias(f"_x{i}") for i in range(1, max_lags + 1)])
    rows = lagged.where(F.col("_y").isNotNull()).withColumn("lags", F.explode(F.sequence(F.lit(0), F.lit(max_lags))))
    names = [f"_x{i}" for i in range(max_lags + 1)]

    def used(i: int) -> Column:
        # A lag beyond the model's own is constant, hence dropped by the solver.
        return F.when(F.col("lags") >= i, F.col(f"_x{i}")).otherwise(F.lit(0.0))

    design = rows.select(SERIES, "lags", *[used(i).alias(n) for i, n in enumerate(names)], "_y").na.drop()
    size = max_lags + 2
    columns = [*names, "_y"]
    sums = moments(design, [SERIES, "lags"], columns).withColumnRenamed("comoment", "cov")
    models = sums.groupBy(SERIES).agg(F.array_sort(F.collect_list(F.struct("lags", "n", "cov"))).alias("m"))

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for series, found in zip(pdf[SERIES], pdf["m"]):
                by_lag = {int(x["lags"]): (int(x["n"]), _square(np.asarray(x["cov"], float), size)) for x in found}
                n, cov = by_lag[max(by_lag)]
                scores = []
                for p in range(max(by_lag) + 1):
                    keep = [*range(p + 1), size - 1]
                    sub = cov[np.ix_(keep, keep)]
                    beta, _, _ = solve_centred(sub)
                    sse = n * (sub[-1, -1] - beta @ sub[:-1, -1])
                    scores.append(n * math.log(max(sse, 1e-300) / n) + 2 * (p + 2))
                best = int(np.argmin(scores))
                n, cov = by_lag[best]
                keep = [*range(best + 1), size - 1]
                sub = cov[np.ix_(keep, keep)]
                beta, inverse, _ = solve_centred(sub)
                left = n * (sub[-1, -1] - beta @ sub[:-1, -1])
                spread = left / (n - best - 2) * inverse[0, 0] / n if n > best + 2 else 0.0
                crit = [sum(c / n**i for i, c in enumerate(v)) for v in ADF_CRITICAL.values()]
                # A constant or very short series leaves no spread to divide by.
                if not spread > 1e-18 * max(1.0, float(sub[-1, -1])) or not sub[0, 0] > 0:
                    out.append((series, None, None, best, n, *crit, "undefined"))
                    continue
                stat = float(beta[0] / math.sqrt(spread))
                p_value = adf_p_value(stat)
                out.append((series, stat, p_value, best, n, *crit, "stationary" if p_value < 0.05 else "unit root"))
            names_out = [SERIES, "statistic", "p_value", "lags", "n", "crit_1pct", "crit_5pct", "crit_10pct", "conclusion"]
            yield pd.DataFrame(out, columns=names_out)

    kind = daily.schema[SERIES].dataType.simpleString()
    return models.mapInPandas(
        test,
        f"{SERIES} {kind}, statistic double, p_value double, lags int, n bigint, "
        "crit_1pct double, crit_5pct double, crit_10pct double, conclusion string",
    )


# Published upper-tail points of the level-stationarity statistic.
KPSS_CRITICAL = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


def series_arrays(daily: DataFrame, column: str, out: str = "y") -> DataFrame:
    """(series_id, n, y[]) in date order; an array holds at most one value per calendar day."""
    ordered = F.array_sort(F.collect_list(F.struct("t", F.col(column).cast("double").alias("v"))))
    rows = daily.where(F.col(column).isNotNull()).groupBy(SERIES).agg(F.transform(ordered, lambda x: x.v).alias(out))
    return rows.select(SERIES, F.size(out).alias("n"), out)


def _product(r: Column, n: Column, lag: Column) -> Column:
    """Sum of r_t * r_{t-lag}."""
    both = F.zip_with(F.slice(r, lag + 1, n - lag), F.slice(r, F.lit(1), n - lag), lambda a, b: a * b)
    return F.aggregate(both, F.lit(0.0), lambda s, x: s + x)


def kpss_test(daily: DataFrame, column: str, lags: int | None = None) -> DataFrame:
    """Level stationarity: statistic, p (held within 0.01..0.10), bandwidth.

    ``lags=None`` chooses the Bartlett bandwidth from the data (Hobijn et al. 1998).
    """
    whole = Window.partitionBy(SERIES)
    residual = daily.where(F.col(column).isNotNull()).select(
        SERIES, "t", (F.col(column) - F.avg(column).over(whole)).alias("r")
    )
    running = residual.select(
        SERIES, "t", "r", F.sum("r").over(along().rowsBetween(Window.unboundedPreceding, 0)).alias("_c")
    )
    ordered = F.array_sort(F.collect_list(F.struct("t", "r")))
    rows = running.groupBy(SERIES).agg(
        F.transform(ordered, lambda x: x.r).alias("r"), F.sum(F.col("_c") * F.col("_c")).alias("_eta")
    ).withColumn("n", F.size("r"))
    r, n = F.col("r"), F.col("n")
    if lags is None:
        few = F.floor(F.pow(n, F.lit(2 / 9))).cast("int")
        rows = rows.withColumn(
            "_few", F.transform(F.sequence(F.lit(1), F.greatest(few, F.lit(1))), lambda i: _product(r, n, i) * 2 / n)
        )
        zero = F.aggregate(F.col("_few"), _product(r, n, F.lit(0)) / n, lambda s, x: s + x)
        first = F.aggregate(
            F.transform("_few", lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x
        )
        ratio = first / F.nullif(zero, F.lit(0.0))
        width = 1.1447 * F.pow(ratio * ratio, F.lit(1 / 3)) * F.pow(n, F.lit(1 / 3))
        rows = rows.withColumn("lags", F.least(F.floor(F.coalesce(width, F.lit(0.0))).cast("int"), n - 1))
    else:
        rows = rows.withColumn("lags", F.least(F.lit(lags), n - 1))
    steps = F.filter(F.sequence(F.lit(0), F.col("lags")), lambda i: i > 0)
    tail = F.aggregate(
        F.transform(steps, lambda i: 2 * _product(r, n, i) * (1 - i / (F.col("lags") + 1))),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    variance = (_product(r, n, F.lit(0)) + tail) / n
    scored = rows.select(SERIES, n.cast("bigint").alias("n"), "lags", ((F.col("_eta") / (n * n)) / F.nullif(variance, F.lit(0.0))).alias("statistic"))
    return scored.withColumn("p_value", _kpss_p(F.col("statistic")))


def _kpss_p(stat: Column) -> Column:
    """Linear between the published points, held at the ends; null for an undefined statistic."""
    out = F.lit(KPSS_CRITICAL[-1][1])
    for (a, pa), (b, pb) in reversed(list(zip(KPSS_CRITICAL, KPSS_CRITICAL[1:]))):
        out = F.when(stat < b, pa + (stat - a) * ((pb - pa) / (b - a))).otherwise(out)
    held = F.when(stat <= KPSS_CRITICAL[0][0], KPSS_CRITICAL[0][1]).otherwise(out)
    return F.when(stat.isNotNull(), held)


def stationarity_decision(adf: DataFrame | None, kpss: DataFrame, level: float = 0.05) -> DataFrame:
    """Both tests in one row: the null is a unit root for ADF and stationarity for KPSS.

    An undefined test (a constant or very short series) decides nothing: null.
    """
    k = kpss.select(
        SERIES,
        F.col("p_value").alias("kpss_p"),
        F.when(F.col("p_value") < level, "not stationary").when(F.col("p_value") >= level, "stationary").alias("kpss"),
    )
    if adf is None:
        return k
    a = adf.select(
        SERIES,
        F.col("p_value").alias("adf_p"),
        F.when(F.col("p_value") < level, "stationary").when(F.col("p_value") >= level, "not stationary").alias("adf"),
    )
    return a.join(k, SERIES)


def ljung_box(daily: DataFrame, column: str, lags: int = 10, model_df: int = 0, p_values: bool = True) -> DataFrame:
    """(series_id, lag, lb_stat, bp_stat[, p values]) for cumulative lags 1..lags."""
    found = acf(daily, column, lags).where("lag > 0")
    upto = Window.partitionBy(SERIES).orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)
    n, r = F.col("n"), F.col("acf")
    stats = found.select(
        SERIES,
        "lag",
        (n * (n + 2) * F.sum(r * r / (n - F.col("lag"))).over(upto)).alias("lb_stat"),
        (n * F.sum(r * r).over(upto)).alias("bp_stat"),
    )
    if not p_values:
        return stats

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            free = pdf["lag"] - model_df
            for name in ("lb", "bp"):
                pdf[f"{name}_p"] = [chi2_tail(x, d) for x, d in zip(pdf[f"{name}_stat"], free)]
            yield pdf

    kind = daily.schema[SERIES].dataType.simpleString()
    return stats.mapInPandas(
        tails, f"{SERIES} {kind}, lag int, lb_stat double, bp_stat double, lb_p double, bp_p double"
    )


def break_variance(daily: DataFrame, column: str, share: float = 1 / 3, p_values: bool = True) -> DataFrame:
    """Sum of squares of the last third over that of the first third; two-sided p."""
    rows = daily.where(F.col(column).isNotNull())
    at = rows.select(
        SERIES,
        F.col(column).alias("_e"),
        F.row_number().over(along()).alias("_i"),
        F.count(F.lit(1)).over(Window.partitionBy(SERIES)).alias("_n"),
    ).withColumn("_h", F.bround(F.col("_n") * F.lit(share), 0))
    square = F.col("_e") * F.col("_e")
    stats = at.groupBy(SERIES).agg(
        F.max("_h").cast("int").alias("h"),
        (
            F.sum(F.when(F.col("_i") > F.col("_n") - F.col("_h"), square))
            / F.nullif(F.sum(F.when(F.col("_i") <= F.col("_h"), square)), F.lit(0.0))
        ).alias("statistic"),
    )
    if not p_values:
        return stats

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            upper = np.array([f_tail(x, h, h) for x, h in zip(pdf["statistic"], pdf["h"])])
            yield pdf.assign(p_value=2 * np.minimum(upper, 1 - upper))

    kind = daily.schema[SERIES].dataType.simpleString()
    return stats.mapInPandas(tails, f"{SERIES} {kind}, h int, statistic double, p_value double")


def jarque_bera(daily: DataFrame, column: str) -> DataFrame:
    """Normality from skewness and kurtosis; the chi-square(2) tail is exp(-x / 2)."""
    stats = daily.groupBy(SERIES).agg(
        F.count(column).alias("n"), F.skewness(column).alias("skew"), (F.kurtosis(column) + 3).alias("kurtosis")
    )
    jb = F.col("n") / 6 * (F.col("skew") * F.col("skew") + (F.col("kurtosis") - 3) * (F.col("kurtosis") - 3) / 4)
    return stats.withColumn("statistic", jb).withColumn("p_value", F.exp(-F.col("statistic") / 2))
