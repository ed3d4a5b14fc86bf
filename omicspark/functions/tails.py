"""Tail probabilities: hypergeometric in expressions, Student and F in vectorised UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series from a shifted argument; error below 1e-12."""
    shifted = n + 10.0
    series = (
        (shifted - 0.5) * F.log(shifted)
        - shifted
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * shifted)
        - 1 / (360 * shifted**3)
        + 1 / (1260 * shifted**5)
        - 1 / (1680 * shifted**7)
    )
    back = sum((F.log(n + float(k)) for k in range(1, 10)), F.lit(0.0))
    return series - back


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric_tail(x: Column, k: Column, n: Column, s: Column) -> Column:
    """P(X >= x) drawing ``s`` of ``n`` of which ``k`` are marked; 1 if nothing was drawn or hit."""
    top = F.least(k, s)
    low = F.greatest(x, s + k - n)
    term = lambda i: F.exp(log_choose(k, i) + log_choose(n - k, s - i) - log_choose(n, s))
    total = F.aggregate(F.sequence(low, top), F.lit(0.0), lambda acc, i: acc + term(i.cast("double")))
    return F.when((s == 0) | (x <= 0), F.lit(1.0)).when(x > top, F.lit(0.0)).otherwise(F.least(F.lit(1.0), total))


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction, element by element."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    gamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(gamma(p + q) - gamma(p) - gamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
        tiny = 1e-300
        c = np.ones_like(y)
        d = 1 / np.where(np.abs(1 - (p + q) * y / (p + 1)) < tiny, tiny, 1 - (p + q) * y / (p + 1))
        out = d.copy()
        for m in range(1, rounds):
            for step in (
                m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)),
                -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1)),
            ):
                d = 1 + step * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + step / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                out = out * d * c
        value = np.where(y <= 0, 0.0, front * out)
    return np.clip(np.where(swap, 1 - value, value), 0, 1)


def student_two_sided(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(incomplete_beta(df / 2, np.full(len(t), 0.5), df / (df + t * t))).where(t.notna() & (df > 0))

    return tail(t.cast("double"), df.cast("double"))


def f_upper(f: Column, df1: Column, df2: Column) -> Column:
    @F.pandas_udf("double")
    def tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return pd.Series(incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f.clip(lower=0)))).where(f.notna() & (d2 > 0))

    return tail(f.cast("double"), df1.cast("double"), df2.cast("double"))
