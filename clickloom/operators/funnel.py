"""Distribution, session, auction and engagement reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions.money import revenue, total
from clickloom.functions.ratios import fraction
from clickloom.operators.campaigns import TYPE_COUNTS, type_counts
from clickloom.operators.ordered import exact_percentiles


def ctr_by_format(events: DataFrame) -> DataFrame:
    return events.groupBy("ad_format").agg(*type_counts()).select(
        "ad_format", "impressions", "clicks", fraction(F.col("clicks"), F.col("impressions")).alias("ctr"))


def cvr_by_device(events: DataFrame) -> DataFrame:
    return events.groupBy("device_type").agg(*type_counts()).select(
        "device_type", "clicks", "conversions", fraction(F.col("conversions"), F.col("clicks")).alias("cvr"))


def share_of_total(events: DataFrame, *keys: str) -> DataFrame:
    """Events per key value and their share of all counted events."""
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))
    everything = counts.agg(F.sum("events")).scalar()
    return counts.select(
        *keys, "events", (F.col("events").cast("double") / everything.cast("double")).alias("share"))


def session_summary(events: DataFrame) -> DataFrame:
    """One row per session id."""
    return events.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), *type_counts(),
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        ((F.max("timestamp") - F.min("timestamp")).cast("double") / 1000).alias("duration_seconds"),
        total(revenue()).alias("revenue"),
    )


def auction_summary(events: DataFrame) -> DataFrame:
    """Bids, wins, win rate and spend per ad format."""
    counts = events.groupBy("ad_format").agg(
        F.count("bid_price_usd").alias("bids"), F.count("win_price_usd").alias("wins"),
        total(F.col("bid_price_usd").cast("decimal(18,4)")).alias("bid_total_usd"),
        total(F.col("win_price_usd").cast("decimal(18,4)")).alias("spend_usd"))
    return counts.select("*", fraction(F.col("wins"), F.col("bids")).alias("win_rate"))


def engagement_summary(events: DataFrame) -> DataFrame:
    """Mean viewability, and engagement time with its median and 95th percentile, per ad format."""
    means = events.groupBy("ad_format").agg(
        F.count("engagement_duration_ms").alias("measured"),
        (F.sum(F.col("viewability_score").cast("decimal(18,4)")).cast("double")
         / F.count("viewability_score").cast("double")).alias("avg_viewability"),
        (F.sum("engagement_duration_ms").cast("double")
         / F.count("engagement_duration_ms").cast("double")).alias("avg_engagement_ms"))
    spread = exact_percentiles(events, ["ad_format"], "engagement_duration_ms", {"p50_ms": 50, "p95_ms": 95})
    return means.join(spread, "ad_format", "left")
