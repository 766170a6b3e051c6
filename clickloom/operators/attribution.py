"""Last-touch attribution: clicks to impressions, conversions to clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.ordered import slice_rows, with_last_known
from clickloom.schema import HOUR_MS

CLICK_KEYS = ("user_id", "session_id", "campaign_id", "ad_id")
CONVERSION_KEYS = ("user_id", "campaign_id", "ad_id")
CLICK_GAP_MS = (1_000, 300_000)
CONVERSION_GAP_MS = (360_000, 168 * HOUR_MS)


def last_touch(targets: DataFrame, touches: DataFrame, keys: tuple[str, ...], gap_ms: tuple[int, int]) -> DataFrame:
    """Give every target the newest touch of the same keys that lies between the two gaps before it.

    A touch enters the timeline at the moment it becomes old enough, so the newest entry at or before a target is
    the answer if it is not too old. This needs one ordered pass and never pairs rows; a hot key spans slices.
    """
    least, most = gap_ms
    entry = F.struct(F.col("event_id").alias("id"), F.col("timestamp").alias("at"),
                     F.col("campaign_id").alias("campaign"), F.col("ad_id").alias("ad"))
    all_keys_known = F.lit(True)
    for key in keys:
        all_keys_known = all_keys_known & F.col(key).isNotNull()
    entered = touches.where(all_keys_known).select(
        *keys, (F.col("timestamp") + least).alias("_at"), F.lit(0).alias("_kind"), F.col("event_id").alias("_id"),
        entry.alias("_touch"))
    waiting = targets.select(
        *keys, F.col("timestamp").alias("_at"), F.lit(1).alias("_kind"), F.col("event_id").alias("_id"),
        F.lit(None).cast(entered.schema["_touch"].dataType).alias("_touch"))
    timeline = slice_rows(entered.unionByName(waiting), list(keys), ["_at", "_kind", "_id"])
    answered = with_last_known(timeline, "_touch", "_found").where(F.col("_kind") == 1)
    fresh = F.when(F.col("_at") - F.col("_found.at") <= most, F.col("_found"))
    return answered.select(
        F.col("_id").alias("event_id"), F.col("_at").alias("timestamp"), *keys, fresh.alias("touch"))


def attribute_clicks(events: DataFrame, keys: tuple[str, ...] = CLICK_KEYS,
                     gap_ms: tuple[int, int] = CLICK_GAP_MS) -> DataFrame:
    clicks = events.where(F.col("event_type") == "click")
    impressions = events.where(F.col("event_type") == "impression")
    return last_touch(clicks, impressions, keys, gap_ms).select(
        F.col("event_id").alias("click_id"), "user_id", "timestamp",
        F.col("touch.id").alias("impression_id"),
        ((F.col("timestamp") - F.col("touch.at")).cast("double") / 1000).alias("seconds_to_click"),
    )


def attribute_conversions(events: DataFrame, keys: tuple[str, ...] = CONVERSION_KEYS,
                          gap_ms: tuple[int, int] = CONVERSION_GAP_MS) -> DataFrame:
    conversions = events.where(F.col("event_type") == "conversion")
    clicks = events.where(F.col("event_type") == "click")
    return last_touch(conversions, clicks, keys, gap_ms).select(
        F.col("event_id").alias("conversion_id"), "user_id", "timestamp",
        F.col("touch.id").alias("click_id"),
        F.col("touch.campaign").alias("attributed_campaign_id"),
        F.col("touch.ad").alias("attributed_ad_id"),
        ((F.col("timestamp") - F.col("touch.at")).cast("double") / HOUR_MS).alias("time_to_conversion_hours"),
    )


def attribution_check(events: DataFrame, keys: tuple[str, ...] = ("user_id",),
                      gap_ms: tuple[int, int] = CONVERSION_GAP_MS) -> DataFrame:
    """Compare the measured last touch with what each conversion itself claims."""
    claimed = events.where(F.col("event_type") == "conversion").select(
        F.col("event_id").alias("conversion_id"),
        F.col("attributed_campaign_id").alias("_campaign"), F.col("attributed_ad_id").alias("_ad"),
        "conversion_value_usd")
    joined = claimed.join(attribute_conversions(events, keys, gap_ms), "conversion_id")
    outcome = (
        F.when(F.col("click_id").isNull(), "unattributed")
        .when((F.col("_campaign") == F.col("attributed_campaign_id")) & (F.col("_ad") == F.col("attributed_ad_id")), "agrees")
        .when(F.col("_campaign") == F.col("attributed_campaign_id"), "other_ad")
        .otherwise("other_campaign")
    )
    return joined.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("conversions"),
        F.sum("conversion_value_usd").cast("double").alias("conversion_value_usd"))
