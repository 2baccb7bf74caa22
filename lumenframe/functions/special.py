"""Tail probabilities used by the tests (numpy only; called on one value per group)."""

from __future__ import annotations

import math

import numpy as np


def _gamma_lower(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function P(a, x)."""
    if x <= 0:
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return total * front
    # Continued fraction of the upper tail (modified Lentz).
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - front * h


def chi2_tail(x: float, df: float) -> float:
    """P(chi-square > x)."""
    if df <= 0 or not math.isfinite(x):
        return math.nan
    return min(max(1 - _gamma_lower(df / 2, x / 2), 0.0), 1.0)


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d or tiny)
        c = 1 + even / c or tiny
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d or tiny)
        c = 1 + odd / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def f_tail(x: float, d1: float, d2: float) -> float:
    """P(F > x)."""
    if x <= 0:
        return 1.0
    return beta_cdf(d2 / 2, d1 / 2, d2 / (d2 + d1 * x))


def student_two_sided(t: np.ndarray, df: float) -> np.ndarray:
    """P(|T| > |t|) element by element."""
    return np.array(
        [math.nan if not math.isfinite(v) else beta_cdf(df / 2, 0.5, df / (df + v * v)) for v in np.atleast_1d(t)]
    )


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))
