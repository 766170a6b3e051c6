"""Lookups of single events: newest first, per key, and the arrival-order sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.sources.silver import day_column

MINUTE_MS = 60_000


def _bounded(limit: int, most: int = 1000) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be 1..{most}")
    return limit


def _top(events: DataFrame, limit: int) -> DataFrame:
    """A top-k inside every task, then one merge of those."""
    return events.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(limit)


def newest(events: DataFrame, limit: int = 100) -> DataFrame:
    """The newest events. On a dated table only the newest days that hold enough rows are read, so that the merge
    gets the top rows of a day's tasks, not of all tasks; the days come from row counts per date partition."""
    _bounded(limit)
    if "event_date" not in events.columns:
        return _top(events, limit)
    days = events.groupBy("event_date").agg(F.count(F.lit(1)).alias("_n"))
    from_newest = Window.orderBy(F.desc("event_date")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = days.select("event_date", F.sum("_n").over(from_newest).alias("_cum")).where(F.col("_cum") >= limit)
    first_day = enough.agg(F.max("event_date")).scalar()
    recent = events.where(F.col("event_date") >= F.coalesce(first_day, F.lit("0001-01-01").cast("date")))
    return _top(recent, limit)


def campaign_events(events: DataFrame, campaign_id: str, event_type: str | None = None, limit: int = 100) -> DataFrame:
    found = events.where(F.col("campaign_id") == campaign_id)
    if event_type:
        found = found.where(F.col("event_type") == event_type)
    return _top(found, _bounded(limit))


def campaign_day_events(events: DataFrame, campaign_id: str, day: str, limit: int = 100) -> DataFrame:
    on_day = day_column(events) == F.lit(day).cast("date")
    return _top(events.where((F.col("campaign_id") == campaign_id) & on_day), _bounded(limit))


def user_events(events: DataFrame, user_id: str, limit: int = 50) -> DataFrame:
    return _top(events.where(F.col("user_id") == user_id), _bounded(limit, 200))


def events_by_type(events: DataFrame, event_type: str, limit: int = 100) -> DataFrame:
    return _top(events.where(F.col("event_type") == event_type), _bounded(limit))


def newest_per_key(events: DataFrame, key: str, limit: int = 10) -> DataFrame:
    """The newest rows of every key. The rank filter prunes inside each task before the shuffle."""
    order = Window.partitionBy(key).orderBy(F.desc("timestamp"), F.desc("event_id"))
    return (
        events.where(F.col(key).isNotNull())
        .withColumn("recency", F.row_number().over(order))
        .where(F.col("recency") <= limit)
    )


def first_arrivals(events: DataFrame, limit: int = 100_000) -> DataFrame:
    """The first rows by time. A per-minute histogram finds the minute in which the limit is reached, so that only
    rows up to it are sorted."""
    minute = F.floor(F.col("timestamp") / MINUTE_MS)
    histogram = events.groupBy(minute.alias("_minute")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per minute of history: small enough for a single ordered pass.
    upto = Window.orderBy("_minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = histogram.select("_minute", F.sum("_n").over(upto).alias("_cum")).where(F.col("_cum") >= limit)
    last_minute = reached.agg(F.min("_minute")).scalar()
    candidates = events.where(minute <= F.coalesce(last_minute, minute))
    return candidates.orderBy("timestamp", "event_id").limit(limit)
