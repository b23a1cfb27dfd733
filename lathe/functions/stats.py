"""Distribution tails for test statistics.

p-values are needed for a handful of result rows (one per tested column), so
they are a small vectorised pandas UDF over the already-aggregated table; the
heavy work (contingency counts, rank sums) stays in Spark aggregates.
The algorithms are the textbook series / continued fraction for the
regularised incomplete gamma function and ``erfc`` for the normal tail.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x is None or a is None or math.isnan(x) or math.isnan(a):
        return float("nan")
    if x <= 0:
        return 1.0
    log_pre = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1.0:
        ap, term = a, 1.0 / a
        total = term
        for _ in range(10_000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return max(0.0, 1.0 - total * math.exp(log_pre))
    b = x + 1.0 - a
    cf = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        cf = b + an / cf
        cf = _TINY if abs(cf) < _TINY else cf
        d = 1.0 / d
        delta = d * cf
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(log_pre) * h


def chi2_sf(x: float, dof: float) -> float:
    """P(X > x) for X ~ chi-square(dof); dof 0 -> 1.0 (no test possible)."""
    if dof is None or dof <= 0:
        return 1.0
    return gamma_q(dof / 2.0, x / 2.0)


def normal_two_sided(z: float) -> float:
    """2 * P(Z > |z|), clipped to 1."""
    if z is None or math.isnan(z):
        return float("nan")
    return min(1.0, math.erfc(abs(z) / math.sqrt(2.0)))


@F.pandas_udf(T.DoubleType())
def _chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(a), float(b)) if pd.notna(a) else None for a, b in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _norm2_udf(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(float(a)) if pd.notna(a) else None for a in z], dtype="float64")


def chi2_pvalue(x: Column, dof: Column) -> Column:
    """Column p-value for a chi-square statistic (use on aggregated rows only)."""
    return _chi2_sf_udf(x.cast("double"), dof.cast("double"))


def normal_pvalue_two_sided(z: Column) -> Column:
    return _norm2_udf(z.cast("double"))


def bias_corrected_skew(g1: Column, n: Column) -> Column:
    """Sample skewness G1 from Spark's population skewness g1 (pandas/DuckDB form)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def bias_corrected_kurtosis(g2: Column, n: Column) -> Column:
    """Sample excess kurtosis G2 from Spark's population excess kurtosis g2."""
    n = n.cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
