"""Revenue per event, under five definitions, and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom.schema import MONEY


def amount(name: str) -> Column:
    """A money column as an exact decimal; sums of it do not depend on row order. Out of range is null."""
    return F.col(name).try_cast(MONEY)


def _or_zero(name: str) -> Column:
    return F.coalesce(amount(name), F.lit(0).cast(MONEY))


def revenue(mode: str = "revenue_plus_value") -> Column:
    """Revenue of one event.

    revenue_plus_value   revenue and conversion value added (the live counters)
    first_nonzero        revenue, else conversion value
    conversions_only     revenue, of conversions only
    all_types            revenue, of every event type
    revenue_or_zero      the bare revenue column, null as 0
    """
    if mode == "revenue_plus_value":
        return _or_zero("revenue_usd") + _or_zero("conversion_value_usd")
    if mode == "first_nonzero":
        zero = F.lit(0).cast(MONEY)
        return F.coalesce(F.nullif(amount("revenue_usd"), zero),
                          F.nullif(amount("conversion_value_usd"), zero), zero)
    if mode == "conversions_only":
        return F.when(F.col("event_type") == "conversion", _or_zero("revenue_usd")).otherwise(F.lit(0).cast(MONEY))
    if mode in ("all_types", "revenue_or_zero"):
        return _or_zero("revenue_usd")
    raise ValueError(f"unknown revenue mode: {mode}")


REVENUE_MODES = ("revenue_plus_value", "first_nonzero", "conversions_only", "all_types", "revenue_or_zero")


def total(value: Column) -> Column:
    """Exact sum, 0 on no rows, handed out as a double."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("double")


def total_cents(value: Column) -> Column:
    """Exact sum rounded half-up to cents before it becomes a double."""
    return F.round(F.coalesce(F.sum(value), F.lit(0)), 2).cast("double")
