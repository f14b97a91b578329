"""Aggregate building blocks: masked and null-propagating weighted means, shape statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def masked_wavg_parts(value: str | Column, weight: str | Column) -> tuple[Column, Column]:
    """A3 partial sums: sum(v*w) and sum(w) over rows with finite v, finite w and w > 0."""
    v, w = _c(value).cast("double"), _c(weight).cast("double")
    ok = is_finite(v) & is_finite(w) & (w > 0)
    return F.sum(F.when(ok, v * w)), F.sum(F.when(ok, w))


def masked_wavg(value: str | Column, weight: str | Column) -> Column:
    """A3: weighted mean that skips bad rows; null when no row qualifies."""
    num, den = masked_wavg_parts(value, weight)
    return F.try_divide(num, F.nullif(den, F.lit(0.0)))


def propagating_wavg(value: str | Column, weight: str | Column, rows: Column | None = None) -> Column:
    """sum(v*w)/sum(w) over ``rows`` (all by default); any null value among them, or a total
    <= 0, gives null."""
    rows = F.lit(True) if rows is None else rows
    v, w = F.when(rows, _c(value).cast("double")), F.when(rows, _c(weight).cast("double"))
    total = F.sum(w)
    return F.when((F.count_if(rows & v.isNull()) == 0) & (total > 0), F.try_divide(F.sum(v * w), total))


def bias_corrected_skew(x: str | Column) -> Column:
    """Sample skewness G1 = g1 * sqrt(n(n-1))/(n-2), n > 2; a constant column gives 0."""
    n = F.count(_c(x)).cast("double")
    g1 = F.coalesce(F.skewness(_c(x)), F.lit(0.0))
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def excess_kurtosis(x: str | Column) -> Column:
    """Sample excess kurtosis G2 = (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6), n > 3."""
    n = F.count(_c(x)).cast("double")
    g2 = F.kurtosis(_c(x))
    val = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n > 3, F.when(g2.isNull(), F.lit(0.0)).otherwise(val))


def round_ratio_half_even(num: str | Column, den: str | Column, scale: int = 100, decimals: int = 2) -> Column:
    """round(num / den * scale, decimals) with half-to-even ties, computed exactly in
    integer arithmetic (count ratios), so every engine gives the same double."""
    p = 10 ** decimals
    n = _c(num).cast("decimal(38,0)") * F.lit(scale * p)
    d = _c(den).cast("decimal(38,0)")
    q = F.floor(n / d)
    rem = n - q * d
    twice = rem * 2
    up = (twice > d) | ((twice == d) & (q % 2 == 1))
    return (F.when(up, q + 1).otherwise(q).cast("double") / F.lit(float(p))).cast("double")
