"""Tail probabilities for the few result rows of a test."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300


def gamma_tail(a: float, x: float) -> float:
    """Regularized upper incomplete gamma."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or _TINY)
        c = b + an / c or _TINY
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def beta_share(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, 10_000):
        up = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        down = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (up, down):
            d = 1 / (1 + step * d or _TINY)
            c = 1 + step / c or _TINY
            h *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return front * h / a


def chi2_tail(stat: float, dof: float) -> float:
    return gamma_tail(dof / 2, stat / 2)


def t_two_sided(stat: float, dof: float) -> float:
    return beta_share(dof / 2, 0.5, dof / (dof + stat * stat))


def normal_two_sided(z: float) -> float:
    return min(1.0, math.erfc(z / math.sqrt(2)))


def _over_rows(fn, *cols: Column) -> Column:
    """Apply a scalar function to Arrow batches of result rows; null where an input is."""

    def batch(*parts: pd.Series) -> pd.Series:
        rows = zip(*parts)
        out = [None if any(pd.isna(x) for x in row) else fn(*row) for row in rows]
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(batch, T.DoubleType())(*cols)


def chi2_p(stat: Column, dof: Column) -> Column:
    """P-value of a chi-square statistic. For result rows, not for raw rows."""
    return _over_rows(chi2_tail, stat, dof)


def t_p(stat: Column, dof: Column) -> Column:
    """Two-sided p-value of a t statistic."""
    return _over_rows(t_two_sided, stat, dof)


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a z score, at most 1."""
    return _over_rows(normal_two_sided, z)


# Ship these functions with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
