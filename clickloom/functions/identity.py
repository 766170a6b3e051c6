"""Event identity and storage keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def event_key() -> Column:
    """The event's own id, or the first 16 hex digits of an MD5 over its key fields."""
    own = F.nullif(F.col("event_id").cast("string"), F.lit(""))
    key_fields = F.concat(
        _text("timestamp"), F.lit("|"), _text("user_id"), F.lit("|"),
        _text("campaign_id"), F.lit("|"), _text("event_type"),
    )
    return F.coalesce(own, F.substring(F.md5(key_fields), 1, 16))


def partition_key() -> Column:
    day = F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd")
    return F.concat(F.coalesce("campaign_id", F.lit("unknown")), F.lit("#"), day)


def sort_key() -> Column:
    stamp = F.lpad(F.col("timestamp").cast("string"), 16, "0")
    return F.concat(stamp, F.lit("#"), F.coalesce("event_id", F.lit("unknown")))
