"""Aggregates that Spark has under another name or not at all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def median(x: Column | str) -> Column:
    """Exact, interpolated."""
    return F.percentile(x, F.lit(0.5))


def quantile(x: Column | str, q: float) -> Column:
    return F.percentile(x, F.lit(q))


def last_by(x: Column | str, *order: Column | str) -> Column:
    """x of the row that is last in the order, null too."""
    return F.max_by(x, F.struct(*order) if len(order) > 1 else order[0])


def skew(x: Column | str) -> Column:
    """Adjusted Fisher-Pearson skewness; null below 3 values or without spread."""
    x = F.col(x) if isinstance(x, str) else x
    n = F.count(x).cast("double")
    return F.when((n >= 3) & (F.stddev_pop(x) > 0), F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def vwap(price: Column | str, volume: Column | str) -> Column:
    """Volume-weighted mean; null where the volumes sum to 0."""
    p, v = (F.col(x) if isinstance(x, str) else x for x in (price, volume))
    return F.sum(p * v) / F.nullif(F.sum(v), F.lit(0))


def slope(y: Column | str, x: Column | str) -> Column:
    return F.regr_slope(y, x)


def half_even(x: Column | str, digits: int = 2) -> Column:
    """A number's decimal spelling, rounded half to even, as decimal(28, digits)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.bround(x.cast("string").cast("decimal(28,12)"), digits).cast(f"decimal(28,{digits})")


def none_as_zero(*columns: Column | str) -> Column:
    """Sum of columns in which nulls count as 0."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return total
