"""Student-t tail probability (§8.6) for the few rows of a test result.

scipy is not available, so the regularised incomplete beta function is
evaluated with the standard continued fraction (Lentz's method).  It runs
inside an Arrow-batched pandas UDF over the tiny per-comparison result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _betacf(a: float, b: float, x: float, itmax: int = 300, eps: float = 3e-16) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(c) > tiny else 1.0 + aa / tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c if abs(c) > tiny else 1.0 + aa / tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    if t is None or dof is None or not math.isfinite(t) or dof <= 0:
        return float("nan") if t is None or not (t == t) else (0.0 if not math.isfinite(t) else float("nan"))
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(DoubleType())
def t_two_sided_p_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, dof)],
                     dtype="float64")
