"""Gamma-family and t-distribution functions on arrays, and their Arrow forms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def digamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    while np.any(small := x < 8):
        shift[small] -= 1 / x[small]
        x = np.where(small, x + 1, x)
    inv = 1 / (x * x)
    series = inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv * (1 / 240 - inv / 132))))
    return shift + np.log(x) - 0.5 / x - series


def trigamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    while np.any(small := x < 8):
        shift[small] += 1 / x[small] ** 2
        x = np.where(small, x + 1, x)
    inv = 1 / (x * x)
    series = 1 / 6 - inv * (1 / 30 - inv * (1 / 42 - inv * (1 / 30 - inv * 5 / 66)))
    return shift + 1 / x + inv / 2 + inv / x * series


def trigamma_inverse(y: np.ndarray) -> np.ndarray:
    """x with trigamma(x) = y; infinite where y is not positive."""
    y = np.array(y, dtype=float)
    x = np.full_like(y, np.inf)
    solve = y > 0
    if not solve.any():
        return x
    target = y[solve]
    # Bisection on log x: trigamma falls from 1/x^2 to 1/x, so the root lies between these.
    low, high = np.log(np.minimum(1 / np.sqrt(target), 1 / target)) - 1, np.log(1 / target + 1 / np.sqrt(target)) + 1
    for _ in range(80):
        middle = (low + high) / 2
        above = trigamma(np.exp(middle)) > target
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    x[solve] = np.exp((low + high) / 2)
    return x


def log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    while np.any(small := x < 8):
        shift[small] -= np.log(x[small])
        x = np.where(small, x + 1, x)
    inv = 1 / (x * x)
    series = (1 / 12 - inv * (1 / 360 - inv * (1 / 1260 - inv * (1 / 1680 - inv / 1188)))) / x
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction (modified Lentz)."""
    a, b, x = (np.array(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    front = np.where(x <= 0, 0.0, front)
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 500):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + term * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            value = value * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    result = front * value
    return np.where(swap, 1 - result, result)


def normal_two_sided(t: np.ndarray) -> np.ndarray:
    """P(|Z| > t) as the limit of large degrees of freedom."""
    return two_sided_t(t, np.full_like(np.asarray(t, dtype=float), 1e8))


def two_sided_t(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) on ``df`` degrees of freedom; infinite df is taken as 1e8."""
    t, df = np.asarray(t, dtype=float), np.minimum(np.asarray(df, dtype=float), 1e8)
    bad = np.isnan(t) | np.isnan(df)
    safe_df = np.where(bad, 1.0, df)
    p = incomplete_beta(safe_df / 2, np.full_like(safe_df, 0.5), safe_df / (safe_df + np.where(bad, 0.0, t) ** 2))
    return np.where(bad, np.nan, p)


def t_for_two_sided(p: np.ndarray, df: np.ndarray) -> np.ndarray:
    """The positive t with P(|T| > t) = p, by bisection."""
    p, df = np.asarray(p, dtype=float), np.asarray(df, dtype=float)
    low, high = np.zeros_like(p), np.full_like(p, 1.0)
    for _ in range(60):
        grow = two_sided_t(high, df) > p
        if not grow.any():
            break
        high = np.where(grow, high * 4, high)
    for _ in range(90):
        middle = (low + high) / 2
        above = two_sided_t(middle, df) > p
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


DOUBLE = T.DoubleType()


def digamma_of(x: Column) -> Column:
    """Digamma of a positive column: eight steps up, then its series."""
    y = x + 8
    inv = 1 / (y * y)
    series = inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv * (1 / 240 - inv / 132))))
    value = F.log(y) - 0.5 / y - series
    for k in range(8):
        value = value - 1 / (x + k)
    return value


def trigamma_of(x: Column) -> Column:
    """Trigamma of a positive column: eight steps up, then its series."""
    y = x + 8
    inv = 1 / (y * y)
    series = 1 / 6 - inv * (1 / 30 - inv * (1 / 42 - inv * (1 / 30 - inv * 5 / 66)))
    value = 1 / y + inv / 2 + inv / y * series
    for k in range(8):
        value = value + 1 / ((x + k) * (x + k))
    return value


@F.pandas_udf(DOUBLE)
def trigamma_inverse_of(y: pd.Series) -> pd.Series:
    return pd.Series(trigamma_inverse(y.to_numpy()))


@F.pandas_udf(DOUBLE)
def two_sided_t_of(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(two_sided_t(t.to_numpy(), df.to_numpy()))


@F.pandas_udf(DOUBLE)
def t_for_two_sided_of(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_for_two_sided(p.to_numpy(), df.to_numpy()))
