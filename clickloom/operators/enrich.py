"""Raw events to enriched events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import day_of_week, hour_of_day
from clickloom.functions.identity import event_key
from clickloom.functions.money import amount
from clickloom.schema import ENRICHED_COLUMNS, MONEY

_ZERO_DEFAULTS = ("bid_price_usd", "revenue_usd", "conversion_value_usd")


def identified(events: DataFrame) -> DataFrame:
    """Give every event an id."""
    return events.withColumn("event_id", event_key())


def _enriched(name: str, now_ms: Column) -> Column:
    if name == "event_id":
        return event_key().alias(name)
    if name == "event_type":
        return F.coalesce("event_type", F.lit("unknown")).alias(name)
    if name == "timestamp":
        return F.coalesce("timestamp", now_ms).alias(name)
    if name == "processing_timestamp":
        return now_ms.alias(name)
    if name == "hour_of_day":
        return hour_of_day().alias(name)
    if name == "day_of_week":
        return day_of_week().alias(name)
    if name in _ZERO_DEFAULTS:
        return F.coalesce(amount(name), F.lit(0).cast(MONEY)).alias(name)
    return F.col(name)


def enrich(events: DataFrame, columns: tuple[str, ...] = ENRICHED_COLUMNS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Project to the enriched layout; ``extra`` columns pass through.

    The time parts use the event's own time, so an event without one should be quarantined first.
    """
    now_ms = F.unix_millis(F.current_timestamp())
    return events.select(*[_enriched(name, now_ms) for name in columns], *extra)
