"""Arithmetic with the pipeline's rules for missing values, zero denominators and rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit factors.
KWH_PER_MWH, MWH_PER_GWH, KWH_PER_KBTU = 1000.0, 1000.0, 0.293071


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str) -> Column:
    """NaN is a missing value in the inputs; as NULL, aggregates skip it."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def row_sum(*columns: Column | str) -> Column:
    """Sum across columns; missing values count as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(_col(c), F.lit(0.0)) for c in columns))


def total(c: Column | str) -> Column:
    """Group sum that is 0 where all values are missing."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def weighted(columns: list[str], weight: str = "weight") -> dict[str, Column]:
    return {c: F.col(c) * F.col(weight) for c in columns}


def safe_div(a: Column, b: Column) -> Column:
    """NULL where the denominator is 0."""
    return a / F.nullif(b, F.lit(0.0))


def pct_diff(ref: Column, reg: Column) -> Column:
    """Percent by which reg exceeds ref; NULL where ref is 0."""
    return F.lit(100.0) * safe_div(reg - ref, ref)


def ratio(a: Column, b: Column, places: int = 4) -> Column:
    return F.bround(safe_div(a, b), places)


def clip_low(c: Column, low: float = 0.0) -> Column:
    """Values below low become low; missing values stay missing."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def kwh_to_mwh(c: Column, places: int = 6) -> Column:
    return F.bround(c / KWH_PER_MWH, places)


def mwh_to_gwh(c: Column) -> Column:
    return c / MWH_PER_GWH


def kbtu_to_kwh(c: Column) -> Column:
    return c * KWH_PER_KBTU


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation as an aggregate; NULL where a side does not vary.

    Only rows with both values count. Spark's own corr raises an error on constant columns under ANSI rules."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return safe_div(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
