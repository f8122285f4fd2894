"""Statistics as column expressions, and the exact law of the two-sample statistic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this value the alternating series of the Kolmogorov law needs many terms, above it the theta series does.
_SWITCH = 1.18
_TERMS = 8


def kolmogorov_sf(lam: Column) -> Column:
    """P(K > lam) of the Kolmogorov distribution; both series converge to double precision within eight terms."""
    upper, lower = F.lit(0.0), F.lit(0.0)
    for k in range(1, _TERMS + 1):
        sign = 2.0 if k % 2 else -2.0
        upper = upper + F.lit(sign) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
        lower = lower + F.exp(F.try_divide(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8.0), lam * lam))
    small = F.lit(1.0) - F.try_divide(F.lit(math.sqrt(2 * math.pi)), lam) * lower
    value = F.when(lam <= 0, F.lit(1.0)).when(lam < _SWITCH, small).otherwise(upper)
    return F.when(lam.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))


def ks_exact(n: int, m: int, gap: int) -> float:
    """P(D >= gap / (n * m)) of the two-sample statistic for samples of n and m different values.

    All orders of the two samples are equally likely, so they are random lattice paths from (0, 0) to (n, m); the statistic stays below
    the gap if every point (i, j) has abs(i * m - j * n) < gap. A path that ends in (i, j) came from (i - 1, j) with probability
    i / (i + j), which gives the share of paths inside along the diagonals i + j = k without large numbers.
    """
    if gap <= 0:
        return 1.0
    n, m = min(n, m), max(n, m)
    inside = np.zeros(n + 2)  # inside[i + 1] belongs to i
    inside[1] = 1.0
    for k in range(1, n + m + 1):
        low = max(0, k - m, -((gap - 1 - k * n) // (n + m)))
        high = min(n, k, (k * n + gap - 1) // (n + m))
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        new = (inside[low : high + 1] * i + inside[low + 1 : high + 2] * (k - i)) / k
        inside[: low + 1] = 0.0
        inside[low + 1 : high + 2] = new
    return float(min(1.0, max(0.0, 1.0 - inside[n + 1])))


def ks_exact_sf(n: Column, m: Column, gap: Column) -> Column:
    """``ks_exact`` of a small table's columns; null where the gap is null."""

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(z) else ks_exact(int(x), int(y), int(z)) for x, y, z in zip(a, b, g, strict=True)], dtype="float64")

    return exact(n, m, gap)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
