"""Counters, campaign, device, user and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import campaigns as ca, monitoring as mo
from clickloom.operators.events import first_arrivals
from clickloom.plans.common import events, now, received, registrar

QUERIES: dict = {}
query = registrar(QUERIES)

_MONEY = ("revenue_usd", "conversion_value_usd")
_CAMPAIGN = ("campaign_id", "event_type", *_MONEY)
_QUALITY = ("event_type", "device_type", "campaign_id", "country", "timestamp", *_MONEY)


@query
def processing_totals(spark, sf_dir):
    return ca.processing_totals(events(spark, sf_dir, "user_id", *_CAMPAIGN))


@query
def processing_rates(spark, sf_dir):
    return ca.processing_rates(received(spark, sf_dir))


@query
def events_by_campaign(spark, sf_dir):
    return ca.event_counts(events(spark, sf_dir, "campaign_id"), "campaign_id")


@query
def events_by_user(spark, sf_dir):
    return ca.event_counts(events(spark, sf_dir, "user_id"), "user_id")


@query
def events_by_type_device(spark, sf_dir):
    return ca.event_counts(events(spark, sf_dir, "event_type", "device_type"), "event_type", "device_type")


@query
def realtime_totals(spark, sf_dir):
    return ca.realtime_totals(events(spark, sf_dir, "timestamp", *_MONEY), now(spark, sf_dir))


@query
def campaign_performance(spark, sf_dir):
    return ca.performance_by(events(spark, sf_dir, *_CAMPAIGN), "campaign_id", with_revenue=True)


@query
def device_performance(spark, sf_dir):
    return ca.performance_by(events(spark, sf_dir, "device_type", "event_type"), "device_type")


@query
def hourly_trends(spark, sf_dir):
    return ca.hourly_trends(events(spark, sf_dir, "timestamp", "event_type", *_MONEY), now(spark, sf_dir), 168)


@query
def peak_hour(spark, sf_dir):
    return ca.peak_hour(events(spark, sf_dir, "timestamp", "event_type", *_MONEY), now(spark, sf_dir), 24)


@query
def conversion_rates(spark, sf_dir):
    return ca.conversion_rates(events(spark, sf_dir, "event_type"))


@query
def campaign_performance_range(spark, sf_dir):
    return ca.campaign_performance_range(
        events(spark, sf_dir, "timestamp", "user_id", *_CAMPAIGN), "2024-01-08", "2024-01-21")


@query
def campaign_metrics_bucketed(spark, sf_dir):
    return ca.campaign_metrics_bucketed(events(spark, sf_dir, "timestamp", "user_id", *_CAMPAIGN))


@query
def campaign_metrics_today(spark, sf_dir):
    return ca.campaign_metrics_today(
        events(spark, sf_dir, "timestamp", "user_id", *_CAMPAIGN), now(spark, sf_dir))


@query
def user_journey(spark, sf_dir):
    return ca.user_journey(events(spark, sf_dir, "timestamp", "user_id", *_CAMPAIGN))


@query
def dashboard_today(spark, sf_dir):
    return ca.dashboard_today(events(spark, sf_dir, "timestamp", *_CAMPAIGN), now(spark, sf_dir))


def _top(spark, sf_dir, metric):
    return ca.top_performers(
        events(spark, sf_dir, "timestamp", *_CAMPAIGN), now(spark, sf_dir), metric, "month", 50)


@query
def top_performers_revenue(spark, sf_dir):
    return _top(spark, sf_dir, "revenue")


@query
def top_performers_ctr(spark, sf_dir):
    return _top(spark, sf_dir, "ctr")


@query
def top_performers_cvr(spark, sf_dir):
    return _top(spark, sf_dir, "conversion_rate")


@query
def top_performers_clicks(spark, sf_dir):
    return _top(spark, sf_dir, "clicks")


@query
def campaign_hourly(spark, sf_dir):
    return ca.campaign_hourly(events(spark, sf_dir, "timestamp", *_CAMPAIGN))


@query
def top_campaigns_active(spark, sf_dir):
    return ca.top_campaigns_active(campaign_hourly(spark, sf_dir))


@query
def minute_history(spark, sf_dir):
    batches = mo.batch_summaries(events(spark, sf_dir, "timestamp", "event_type", *_MONEY), 10_000)
    return mo.minute_history(mo.minute_counters(batches, 10_000), now(spark, sf_dir), 1440)


@query
def data_quality(spark, sf_dir):
    return ca.data_quality(events(spark, sf_dir, *_QUALITY))


@query
def data_distributions(spark, sf_dir):
    return ca.data_distributions(events(spark, sf_dir, "event_type", "device_type"))


@query
def data_quality_sample(spark, sf_dir):
    """The operator samples by a limit; 700 cuts the tables used for tests too."""
    return ca.data_quality(first_arrivals(events(spark, sf_dir, *_QUALITY), 700))


@query
def distinct_users_exact(spark, sf_dir):
    return ca.distinct_users(events(spark, sf_dir, "campaign_id", "event_type", "user_id"), "campaign_id", "event_type")
