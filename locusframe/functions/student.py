"""Two-sided p-values of Student's t as an Arrow-batched column function.

The survival function is evaluated directly (regularised incomplete beta),
so tiny p-values keep their magnitude instead of underflowing to 1 - CDF = 0.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 2000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            delta = c * d
            value = value * delta
        if np.all(np.abs(delta - 1.0) < 1e-15):
            break
    return value


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for ``df`` degrees of freedom; NaN where undefined."""
    t = np.abs(np.asarray(t, dtype=float))
    df = np.asarray(df, dtype=float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(df) & (df > 0) & ~np.isnan(t)
    if not ok.any():
        return out
    tt, nu = t[ok], df[ok]
    finite = np.isfinite(tt)
    tt = np.where(finite, tt, 0.0)
    a, b = nu / 2.0, np.full_like(nu, 0.5)
    square = tt * tt
    x = nu / (nu + square)
    y = square / (nu + square)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    log_front = (
        lgamma(a + b) - lgamma(a) - lgamma(b)
        - a * np.log1p(square / nu)
        + b * np.log(np.where(y > 0, y, 1.0))
    )
    front = np.exp(log_front)
    direct = x < (a + 1.0) / (a + b + 2.0)
    p = np.empty_like(tt)
    if direct.any():
        p[direct] = front[direct] * _beta_fraction(a[direct], b[direct], x[direct]) / a[direct]
    rest = ~direct
    if rest.any():
        p[rest] = 1.0 - front[rest] * _beta_fraction(b[rest], a[rest], y[rest]) / b[rest]
    p = np.where(square == 0, 1.0, p)
    out[ok] = np.where(finite, p, 0.0)
    return out


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    p = two_sided_p(t.to_numpy(float), df.to_numpy(float))
    return pd.Series(p).where(~np.isnan(p), None)
