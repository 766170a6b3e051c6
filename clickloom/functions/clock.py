"""Time parts, bucket labels and the reference instant of a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Label patterns of the three time buckets.
BUCKET_PATTERNS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}


def event_time(ms: str = "timestamp") -> Column:
    return F.timestamp_millis(ms)


def event_date(ms: str = "timestamp") -> Column:
    return F.to_date(event_time(ms))


def hour_of_day(ms: str = "timestamp") -> Column:
    return F.hour(event_time(ms))


def day_of_week(ms: str = "timestamp") -> Column:
    """Monday is 0."""
    return F.weekday(event_time(ms))



def as_of(df: DataFrame, instant: int | Column | None = None, column: str = "timestamp") -> Column:
    """The query's "now", in the column's own unit.

    A literal prunes partitions at planning time, so production jobs should pass one. Without it
    "now" is the newest row, read through a scalar subquery: no join and no trip to the driver. On a dated table
    only the newest day's times are read.
    """
    if isinstance(instant, Column):
        return instant
    if instant is not None:
        return F.lit(instant).cast("bigint")
    if "event_date" in df.columns:
        df = df.where(F.col("event_date") == df.agg(F.max("event_date")).scalar())
    return df.agg(F.max(column)).scalar()
