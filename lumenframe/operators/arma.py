"""ARMA models by conditional least squares, many (series, order) pairs at once.

Each pair is one row holding the series as an array (at most one value per
calendar day), so Spark spreads pairs over the cluster and Python only runs the
small solver of one pair.  The estimates condition on zero pre-sample deviations;
they are close to, but not the same as, exact-likelihood estimates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .daily import SERIES
from .ordering import best_row
from .stationarity import series_arrays


def _shift(x: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[k:] = x[: len(x) - k]
    return out


def _stable(poly: np.ndarray) -> bool:
    """Whether 1 + poly_1 z + ... has all roots outside the unit circle."""
    return len(poly) == 0 or np.abs(np.roots(np.append(1.0, poly))).max(initial=0.0) < 0.9999


def _undo_ma(theta: np.ndarray, *signals: np.ndarray) -> list[np.ndarray]:
    """Divide signals by the moving-average polynomial (zero start) through its impulse response."""
    q, n = len(theta), len(signals[0])
    if q == 0:
        return list(signals)
    response = [1.0]
    while len(response) < n:
        recent = response[-1 : -q - 1 : -1]
        response.append(-sum(a * b for a, b in zip(theta, recent)))
        if len(response) > q and max(abs(v) for v in response[-q:]) < 1e-13:
            break
    size = 1 << (n + len(response)).bit_length()
    kernel = np.fft.rfft(response, size)
    return [np.fft.irfft(np.fft.rfft(s, size) * kernel, size)[:n] for s in signals]


@dataclass
class Fit:
    mean: float
    ar: np.ndarray
    ma: np.ndarray
    residuals: np.ndarray
    jacobian: np.ndarray

    @property
    def sse(self) -> float:
        return float(self.residuals @ self.residuals)

    def vector(self) -> np.ndarray:
        return np.concatenate([[self.mean], self.ar, self.ma])

    def next_value(self, y: np.ndarray) -> float:
        d, e = y - self.mean, self.residuals
        ahead = sum(a * d[-i] for i, a in enumerate(self.ar, 1)) + sum(b * e[-j] for j, b in enumerate(self.ma, 1))
        return float(self.mean + ahead)


def _evaluate(y: np.ndarray, params: np.ndarray, p: int, q: int) -> Fit | None:
    mean, ar, ma = params[0], params[1 : p + 1], params[p + 1 :]
    if not (_stable(-ar) and _stable(ma)):
        return None
    d, ones = y - mean, np.ones(len(y))
    a, c = d.copy(), ones.copy()
    for i, v in enumerate(ar, 1):
        a -= v * _shift(d, i)
        c -= v * _shift(ones, i)
    e, w, c = _undo_ma(ma, a, d, c)
    columns = [-c, *[-_shift(w, i) for i in range(1, p + 1)]]
    if q:
        (v,) = _undo_ma(ma, e)
        columns += [-_shift(v, j) for j in range(1, q + 1)]
    return Fit(mean, ar, ma, e, np.column_stack(columns))


def _start(y: np.ndarray, p: int, q: int) -> np.ndarray:
    """Long autoregression for the shocks, then one regression on lags of both."""
    d = y - y.mean()
    if p + q == 0:
        return np.array([y.mean()])
    long = min(max(10, p + q + 2), max(len(y) // 4, 1))
    shocks = d
    if q:
        x = np.column_stack([_shift(d, i) for i in range(1, long + 1)])
        shocks = d - x @ np.linalg.lstsq(x, d, rcond=None)[0]
    x = np.column_stack([_shift(d, i) for i in range(1, p + 1)] + [_shift(shocks, j) for j in range(1, q + 1)])
    beta = np.linalg.lstsq(x[long:], d[long:], rcond=None)[0]
    for _ in range(40):
        if _stable(-beta[:p]) and _stable(beta[p:]):
            break
        beta = beta * 0.8
    return np.concatenate([[y.mean()], beta])


def fit_one(y: np.ndarray, p: int, q: int, start: np.ndarray | None = None, steps: int = 60) -> Fit:
    """Damped Gauss-Newton on the conditional sum of squares."""
    now = _evaluate(y, start if start is not None else _start(y, p, q), p, q)
    if now is None:
        now = _evaluate(y, np.append(y.mean(), np.zeros(p + q)), p, q)
    damp = 1e-3
    for _ in range(steps):
        j, r = now.jacobian, now.residuals
        h, g = j.T @ j, j.T @ r
        better = None
        for _ in range(12):
            step = np.linalg.lstsq(h + damp * np.diag(np.diag(h) + 1e-12), -g, rcond=None)[0]
            trial = _evaluate(y, now.vector() + step, p, q)
            if trial is not None and trial.sse <= now.sse:
                better = trial
                damp = max(damp / 5, 1e-9)
                break
            damp *= 5
        if better is None or now.sse - better.sse <= 1e-10 * now.sse:
            now = better or now
            break
        now = better
    return now


def _criteria(fit: Fit, n: int, k: int) -> tuple[float, float, float, float, float]:
    s2 = fit.sse / n
    ll = -n / 2 * (math.log(2 * math.pi * max(s2, 1e-300)) + 1)
    return s2, ll, -2 * ll + 2 * k, -2 * ll + math.log(n) * k, -2 * ll + 2 * math.log(math.log(n)) * k


FIT_DDL = (
    "p int, q int, n int, const double, ar array<double>, ma array<double>, se array<double>, "
    "z array<double>, sigma2 double, loglik double, aic double, bic double, hqic double, reason string"
)


def _pairs(daily: DataFrame, column: str, orders: list[tuple[int, int]]) -> DataFrame:
    """One row per (series, order): a series is shuffled once and meets its orders after that."""
    choice = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in orders]))
    return series_arrays(daily, column).withColumn("_o", choice).select(SERIES, "y", "_o.p", "_o.q")


def fit_arma(daily: DataFrame, column: str, orders: list[tuple[int, int]]) -> DataFrame:
    """One row per (series, order): coefficients, standard errors, information criteria.

    An order that cannot be fitted has null estimates and says why in ``reason``.
    """
    schema = T.StructType(
        [T.StructField(SERIES, daily.schema[SERIES].dataType), *T.StructType.fromDDL(FIT_DDL).fields]
    )
    names = schema.names

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for series, y, p, q in zip(pdf[SERIES], pdf["y"], pdf["p"], pdf["q"]):
                y = np.asarray(y, float)
                short = len(y) <= p + q + 2
                if short or np.ptp(y) == 0:
                    reason = "too few days for the order" if short else "constant series"
                    out.append((series, p, q, len(y), *[None] * 10, reason))
                    continue
                f = fit_one(y, p, q)
                s2, ll, aic, bic, hqic = _criteria(f, len(y), p + q + 2)
                spread = s2 * np.linalg.pinv(f.jacobian.T @ f.jacobian)
                se = np.sqrt(np.clip(np.diag(spread), 0, None))
                z = f.vector() / np.where(se > 0, se, np.nan)
                out.append((series, p, q, len(y), f.mean, list(f.ar), list(f.ma), list(se), list(z), s2, ll, aic, bic, hqic, None))
            yield pd.DataFrame(out, columns=names)

    return _pairs(daily, column, orders).mapInPandas(solve, schema)


def select_order(daily: DataFrame, column: str, max_ar: int = 4, max_ma: int = 4) -> DataFrame:
    """(series_id, criterion, p, q): the order minimising AIC, BIC and HQIC.

    Orders that could not be fitted lose against any other; a series with none has nulls.
    """
    orders = [(p, q) for p in range(max_ar + 1) for q in range(max_ma + 1)]
    fits = fit_arma(daily, column, orders).select(
        SERIES, "p", "q", F.explode(F.map_from_arrays(
            F.array(F.lit("aic"), F.lit("bic"), F.lit("hqic")), F.array("aic", "bic", "hqic")
        )).alias("criterion", "value")
    )
    fits = fits.withColumns({c: F.when(F.col("value").isNotNull(), F.col(c)) for c in ("p", "q")})
    return best_row(fits, ["p", "q", "value"], F.struct(F.col("value").isNull(), "value", "p", "q"), [SERIES, "criterion"])


def residuals(daily: DataFrame, column: str, p: int, q: int) -> DataFrame:
    """(series_id, t, residual) of one fitted order; t is the date of the observation."""
    kind = daily.schema[SERIES].dataType.simpleString()
    ordered = F.array_sort(F.collect_list(F.struct("t", F.col(column).cast("double").alias("v"))))
    rows = daily.where(F.col(column).isNotNull()).groupBy(SERIES).agg(ordered.alias("_o")).select(
        SERIES, F.col("_o.t").alias("t"), F.col("_o.v").alias("y")
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [list(fit_one(np.asarray(y, float), p, q).residuals) for y in pdf["y"]]
            yield pd.DataFrame({SERIES: pdf[SERIES], "t": pdf["t"], "residual": found})

    fitted = rows.mapInPandas(solve, f"{SERIES} {kind}, t array<date>, residual array<double>")
    each = fitted.select(SERIES, F.explode(F.arrays_zip("t", "residual")).alias("_z"))
    return each.select(SERIES, "_z.t", "_z.residual")


def rolling_forecast(
    daily: DataFrame, column: str, p: int = 0, q: int = 1, share: float = 0.8, block: int = 64
) -> DataFrame:
    """One-step forecasts refitted at every origin of the last part of each series.

    Origins are cut in blocks of consecutive days; a block is one row and starts each
    fit from the estimate of the day before.
    """
    rows = series_arrays(daily, column).withColumn("_cut", F.bround(F.lit(share) * F.col("n"), 0).cast("int"))
    starts = F.explode(F.sequence(F.col("_cut"), F.col("n") - 1, F.lit(block)))
    tasks = rows.where(F.col("_cut") < F.col("n")).select(
        SERIES, starts.alias("_from"), "n", "y"
    ).select(
        SERIES, "_from", F.least(F.col("_from") + block, F.col("n")).alias("_to"), "y"
    )
    parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for series, a, b, y in zip(pdf[SERIES], pdf["_from"], pdf["_to"], pdf["y"]):
                y = np.asarray(y, float)
                start = None
                for at in range(int(a), int(b)):
                    f = fit_one(y[:at], p, q, start)
                    start = f.vector()
                    out.append((series, at, float(y[at]), f.next_value(y[:at])))
            yield pd.DataFrame(out, columns=[SERIES, "position", "y", "forecast"])

    kind = daily.schema[SERIES].dataType.simpleString()
    return tasks.repartition(parts, SERIES, "_from").mapInPandas(
        roll, f"{SERIES} {kind}, position int, y double, forecast double"
    )


