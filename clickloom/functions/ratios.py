"""The four ways a rate is formed. Rounding is half-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_percent(num: Column, den: Column) -> Column:
    """Percent with the denominator lifted to at least 1, two decimals."""
    return F.round(num.cast("double") / F.greatest(den, F.lit(1)).cast("double") * 100, 2)


def fraction(num: Column, den: Column) -> Column:
    """Plain ratio, 0.0 when the denominator is 0."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def percent_or_zero(num: Column, den: Column) -> Column:
    """Percent, two decimals, 0.0 when the denominator is 0."""
    return F.when(den > 0, F.round(num.cast("double") / den.cast("double") * 100, 2)).otherwise(F.lit(0.0))


def percent_or_null(num: Column, den: Column) -> Column:
    """Percent, unrounded, null when the denominator is 0."""
    return F.when(den > 0, num.cast("double") / den.cast("double") * 100)
