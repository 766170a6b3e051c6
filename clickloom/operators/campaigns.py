"""Aggregates over enriched, duplicate-free events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.clock import BUCKET_PATTERNS, hour_of_day
from clickloom.functions.money import REVENUE_MODES, revenue, total, total_cents
from clickloom.functions.ratios import fraction, guarded_percent, percent_or_null, percent_or_zero
from clickloom.schema import DEVICE_TYPES, HOUR_MS
from clickloom.sources.silver import day_column, since

TYPE_COUNTS = (("impressions", "impression"), ("clicks", "click"), ("conversions", "conversion"))


def type_counts() -> list[Column]:
    return [F.count_if(F.col("event_type") == kind).alias(name) for name, kind in TYPE_COUNTS]


def _present(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _clicks_per_impression(formula) -> Column:
    return formula(F.col("clicks"), F.col("impressions"))


def _conversions_per_click(formula) -> Column:
    return formula(F.col("conversions"), F.col("clicks"))


def processing_totals(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("events_processed"),
        *[c.alias(f"{name}_processed") for c, (name, _) in zip(type_counts(), TYPE_COUNTS)],
        total(revenue()).alias("revenue_processed_usd"),
        F.count_distinct(_present("campaign_id")).alias("unique_campaigns"),
        F.count_distinct(_present("user_id")).alias("unique_users"),
    )


def processing_rates(received: DataFrame) -> DataFrame:
    """Rates of the ingest over ``received`` rows, copies included. Unknown event types are errors."""
    per_id = received.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("_copies"), F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"),
        F.max(F.col("event_type") == "unknown").alias("_bad"),
    )
    counts = per_id.agg(
        F.count_if(~F.col("_bad")).alias("processed"),
        F.count_if("_bad").alias("errors"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("deduped"),
        F.count(F.lit(1)).alias("_ids"),
        ((F.max("_last") - F.min("_first")).cast("double") / 1000).alias("elapsed_seconds"),
    )
    processed = F.col("processed").cast("double")
    return counts.select(
        "processed", "errors", "deduped", "elapsed_seconds",
        (processed / F.greatest(F.col("elapsed_seconds"), F.lit(0.001))).alias("events_per_second"),
        (F.col("deduped").cast("double") / F.greatest(processed, F.lit(1.0))).alias("deduplication_rate"),
        (F.col("errors").cast("double") / F.greatest(processed + F.col("errors"), F.lit(1.0))).alias("error_rate"),
        (F.col("_ids").cast("double") * 32 / 1048576).alias("memory_usage_mb"),
    )


def event_counts(events: DataFrame, *keys: str) -> DataFrame:
    """Events per key; rows without the key are left out when there is just one."""
    kept = events.where(_present(keys[0]).isNotNull()) if len(keys) == 1 else events
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))


def realtime_totals(events: DataFrame, now_ms: Column, strict: bool = False) -> DataFrame:
    """All events, and the last hour's events and revenue. ``strict`` leaves rows after "now" out of the hour."""
    recent = F.col("timestamp") >= now_ms - HOUR_MS
    if strict:
        recent = recent & (F.col("timestamp") <= now_ms)
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(recent).alias("events_last_hour"),
        total_cents(F.when(recent, revenue())).alias("revenue_last_hour"),
    )


def performance_by(events: DataFrame, key: str, with_revenue: bool = False) -> DataFrame:
    """Counts, click-through and conversion percentages of every key value."""
    money = [total_cents(revenue()).alias("revenue")] if with_revenue else []
    counts = events.groupBy(key).agg(*type_counts(), *money)
    return counts.select(
        key, *[name for name, _ in TYPE_COUNTS],
        *(["revenue"] if with_revenue else []),
        _clicks_per_impression(guarded_percent).alias("ctr"),
        _conversions_per_click(guarded_percent).alias("cvr"),
    )


def top_campaigns(events: DataFrame, limit: int = 10) -> DataFrame:
    campaigns = performance_by(events, "campaign_id", with_revenue=True)
    return campaigns.orderBy(F.desc("revenue"), "campaign_id").limit(limit)


def hourly_trends(events: DataFrame, now_ms: Column, hours_back: int = 24) -> DataFrame:
    """Counts and revenue per hour of day over the last hours; days fold together."""
    if not 1 <= hours_back <= 168:
        raise ValueError("hours_back must be 1..168")
    return (
        since(events, now_ms - hours_back * HOUR_MS)
        .groupBy(hour_of_day().alias("hour"))
        .agg(*type_counts(), total(revenue()).alias("revenue"))
        .orderBy("hour")
    )


def peak_hour(events: DataFrame, now_ms: Column, hours_back: int = 24) -> DataFrame:
    """The busiest hour of day, the lowest on ties; 0 with nothing in the window, null with no events at all."""
    trends = hourly_trends(events, now_ms, hours_back)
    busy = F.struct((F.col("impressions") + F.col("clicks") + F.col("conversions")).alias("n"), (-F.col("hour")).alias("h"))
    best = trends.agg(F.max(busy).alias("_best"))
    return best.select(
        F.when(now_ms.isNotNull(), F.coalesce(-F.col("_best.h"), F.lit(0))).cast("int").alias("peak_hour"),
        F.lit(hours_back).alias("hours_analyzed"),
    )


def conversion_rates(events: DataFrame) -> DataFrame:
    return events.agg(*type_counts()).select(
        *[name for name, _ in TYPE_COUNTS],
        _clicks_per_impression(guarded_percent).alias("overall_ctr"),
        _conversions_per_click(guarded_percent).alias("overall_cvr"),
        guarded_percent(F.col("conversions"), F.col("impressions")).alias("impressions_to_conversion"),
    )


def _campaign_metrics(events: DataFrame, *keys: str, count_name: str | None = None) -> DataFrame:
    counted = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    grouped = events.groupBy(*keys).agg(
        *counted, *type_counts(),
        total(revenue("conversions_only")).alias("revenue_usd"),
        F.count_distinct(_present("user_id")).alias("unique_users"),
    )
    return grouped.select(
        *grouped.columns,
        _clicks_per_impression(fraction).alias("ctr"),
        _conversions_per_click(fraction).alias("conversion_rate"),
    )


def campaign_performance_range(events: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Every campaign over an inclusive range of UTC dates."""
    ranged = events.where(day_column(events).between(F.lit(start).cast("date"), F.lit(end or start).cast("date")))
    return _campaign_metrics(ranged, "campaign_id", count_name="total_events")


def campaign_metrics_today(events: DataFrame, now_ms: Column) -> DataFrame:
    today = F.to_date(F.timestamp_millis(now_ms))
    return _campaign_metrics(events.where(day_column(events) == today), "campaign_id")


def campaign_metrics_bucketed(events: DataFrame) -> DataFrame:
    """Campaign metrics per hour, day and month.

    Events are folded to (campaign, hour, user) first; only those far fewer rows are expanded to three grains.
    """
    hour = F.date_trunc("hour", F.timestamp_millis("timestamp"))
    folded = events.groupBy("campaign_id", "user_id", hour.alias("_hour")).agg(
        *type_counts(), F.sum(revenue("conversions_only")).alias("_revenue"))
    grains = F.array(*[
        F.struct(F.lit(grain).alias("time_period"), F.date_format("_hour", pattern).alias("time_bucket"))
        for grain, pattern in BUCKET_PATTERNS.items()
    ])
    expanded = folded.select("*", F.inline(grains))
    metrics = expanded.groupBy("campaign_id", "time_period", "time_bucket").agg(
        *[F.sum(name).alias(name) for name, _ in TYPE_COUNTS],
        F.sum("_revenue").cast("double").alias("revenue_usd"),
        F.count_distinct(_present("user_id")).alias("unique_users"),
    )
    return metrics.select(
        *metrics.columns,
        _clicks_per_impression(fraction).alias("ctr"),
        _conversions_per_click(fraction).alias("conversion_rate"),
    )


def user_journey(events: DataFrame) -> DataFrame:
    """Every user's activity. Rows fold to (user, campaign) first, so the campaign list is built from distinct ones."""
    pairs = events.where(_present("user_id").isNotNull()).groupBy("user_id", "campaign_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("timestamp").alias("_min"), F.max("timestamp").alias("_max"),
        *type_counts(), F.sum(revenue("all_types")).alias("_revenue"))
    visited = F.array_join(F.array_sort(F.collect_list(_present("campaign_id"))), ",")
    return pairs.groupBy("user_id").agg(
        F.sum("_n").alias("total_events"),
        F.min("_min").alias("first_seen"), F.max("_max").alias("last_seen"),
        visited.alias("campaigns_visited"),
        *[F.sum(name).alias(name) for name, _ in TYPE_COUNTS],
        F.sum("_revenue").cast("double").alias("total_revenue"),
    )


def dashboard_today(events: DataFrame, now_ms: Column) -> DataFrame:
    """The day of "now": totals, mean rate since midnight, the three best campaigns, average rates.

    Events fold to campaigns first; everything else works on those rows.
    """
    midnight = F.unix_millis(F.date_trunc("day", F.timestamp_millis(now_ms)))
    today = events.where(day_column(events) == F.to_date(F.timestamp_millis(now_ms)))
    campaigns = today.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("_n"), *type_counts(), F.sum(revenue()).alias("_revenue"))
    best = (
        campaigns.orderBy(F.desc("_revenue"), "campaign_id").limit(3)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_revenue")).alias("r"), "campaign_id"))).alias("_best"))
        .select(F.array_join(F.transform("_best", lambda b: b["campaign_id"]), ",").alias("top"))
    )
    sums = campaigns.agg(
        F.sum("_n").alias("total_events_today"), F.sum("_revenue").cast("double").alias("total_revenue_today"),
        *[F.sum(name).alias(name) for name, _ in TYPE_COUNTS])
    seconds = F.greatest((now_ms - midnight).cast("double") / 1000, F.lit(0.001))
    return sums.select(
        "total_events_today",
        (F.col("total_events_today").cast("double") / seconds).alias("events_per_second"),
        best.scalar().alias("top_campaigns"),
        "total_revenue_today",
        _clicks_per_impression(fraction).alias("average_ctr"),
        _conversions_per_click(fraction).alias("conversion_rate"),
    )


_TOP_METRICS = {"revenue": "revenue_usd", "ctr": "ctr", "conversion_rate": "conversion_rate", "clicks": "clicks"}


def top_performers(events: DataFrame, now_ms: Column, metric: str = "revenue", period: str = "day",
                   limit: int = 10) -> DataFrame:
    """The best campaigns of the current hour, day or month by one metric, ranked, with how many were compared."""
    if metric not in _TOP_METRICS or period not in BUCKET_PATTERNS or not 1 <= limit <= 50:
        raise ValueError("metric, period or limit out of range")
    start = F.unix_millis(F.date_trunc(period, F.timestamp_millis(now_ms)))
    grouped = since(events, start).where(F.col("timestamp") <= now_ms).groupBy("campaign_id").agg(
        *type_counts(), total(revenue("conversions_only")).alias("revenue_usd"))
    measured = grouped.select(
        "campaign_id", "revenue_usd", "clicks", "conversions",
        _clicks_per_impression(fraction).alias("ctr"),
        _conversions_per_click(fraction).alias("conversion_rate"),
    )
    score = F.col(_TOP_METRICS[metric])
    # Distinct campaigns fold on the map side; the ranking below sees at most 50 rows.
    analyzed = measured.agg(F.count(F.lit(1))).scalar()
    best = measured.orderBy(score.desc(), "campaign_id").limit(limit)
    return best.select(
        F.rank().over(Window.orderBy(score.desc())).alias("rank"),
        "campaign_id", "revenue_usd", "ctr", "conversion_rate", "clicks", "conversions",
        analyzed.alias("total_analyzed"),
    )


def campaign_hourly(events: DataFrame) -> DataFrame:
    """Campaign counters per hour of event time."""
    value = revenue("first_nonzero")
    return (
        events.where(_present("campaign_id").isNotNull())
        .groupBy("campaign_id", F.floor(F.col("timestamp") / HOUR_MS).alias("hour"))
        .agg(*type_counts(), total(F.when(value > 0, value)).alias("revenue"))
    )


def top_campaigns_active(hourly: DataFrame, limit: int = 10) -> DataFrame:
    """Campaigns with impressions, summed over their hours, best revenue first."""
    summed = hourly.groupBy("campaign_id").agg(
        *[F.sum(name).alias(name) for name, _ in TYPE_COUNTS],
        total(F.col("revenue").cast("decimal(38,4)")).alias("revenue"))
    return (
        summed.where(F.col("impressions") > 0)
        .select(
            "campaign_id", *[name for name, _ in TYPE_COUNTS], "revenue",
            _clicks_per_impression(percent_or_zero).alias("ctr"),
            _conversions_per_click(percent_or_zero).alias("cvr"),
        )
        .orderBy(F.desc("revenue"), "campaign_id").limit(limit)
    )


def data_quality(events: DataFrame) -> DataFrame:
    """Row, type and device counts, revenue, distinct campaigns and countries, both rates."""
    devices = [F.count_if(F.col("device_type") == d).alias(f"{d}_events") for d in DEVICE_TYPES]
    counts = events.agg(
        F.count(F.lit(1)).alias("rows"), *type_counts(), *devices,
        total(revenue()).alias("total_revenue"),
        F.count_distinct(_present("campaign_id")).alias("unique_campaigns"),
        F.count_distinct(_present("country")).alias("unique_countries"),
    )
    return counts.select(
        *counts.columns,
        _clicks_per_impression(percent_or_null).alias("ctr"),
        _conversions_per_click(percent_or_null).alias("cvr"),
    )


def data_distributions(events: DataFrame) -> DataFrame:
    """Events per value of the type and of the device; whatever values there are, null included."""
    dimensions = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("event_type", "device_type")])
    return events.select(F.inline(dimensions)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("events"))


def distinct_users(events: DataFrame, *keys: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return events.groupBy(*keys).agg(count(_present("user_id")).alias("unique_users"))


def revenue_definitions(events: DataFrame) -> DataFrame:
    """Revenue per event type under all five definitions."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        *[total(revenue(mode)).alias(mode) for mode in REVENUE_MODES],
    )
