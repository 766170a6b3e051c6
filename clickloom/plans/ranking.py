"""Newest-first lookups, top lists and per-key samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import campaigns as ca, events as ev, monitoring as mo
from clickloom.plans.common import events, events_matching, now, registrar
from clickloom.sources.adapter import metric_points, table
from clickloom.sources.silver import day_column

QUERIES: dict = {}
query = registrar(QUERIES)

_SHOWN = ("event_type", "timestamp", "user_id", "campaign_id")


def _listed(rows, *more):
    return rows.select("event_id", *_SHOWN, *more)


@query
def latest_events(spark, sf_dir):
    return _listed(ev.newest(events(spark, sf_dir, *_SHOWN), 1000)).orderBy("timestamp", "event_id")


@query
def campaign_events(spark, sf_dir):
    return _listed(ev.campaign_events(events(spark, sf_dir, *_SHOWN), "campaign_7", "click", 100))


@query
def campaign_day_events(spark, sf_dir):
    on_day = F.to_date(F.timestamp_millis("timestamp")) == F.lit("2024-01-15").cast("date")
    read = events_matching(spark, sf_dir, (F.col("campaign_id") == "campaign_7") & on_day, *_SHOWN)
    return _listed(ev.campaign_day_events(read, "campaign_7", "2024-01-15", 100))


@query
def user_events(spark, sf_dir):
    read = events_matching(spark, sf_dir, F.col("user_id") == "user_8", *_SHOWN)
    return _listed(ev.user_events(read, "user_8", 50))


@query
def events_by_type(spark, sf_dir):
    return _listed(ev.events_by_type(events(spark, sf_dir, *_SHOWN), "conversion", 100))


@query
def user_recent_events(spark, sf_dir):
    return _listed(ev.newest_per_key(events(spark, sf_dir, *_SHOWN), "user_id", 10), "recency")


@query
def campaign_recent_events(spark, sf_dir):
    """The ten newest events of the current day for every campaign."""
    read = events(spark, sf_dir, *_SHOWN)
    today = read.where(day_column(read) == F.to_date(F.timestamp_millis(now(spark, sf_dir))))
    return _listed(ev.newest_per_key(today, "campaign_id", 10), "recency")


@query
def top_campaigns(spark, sf_dir):
    return ca.top_campaigns(events(spark, sf_dir, "campaign_id", "event_type", "revenue_usd", "conversion_value_usd"))


@query
def moving_latency(spark, sf_dir):
    return mo.moving_average(metric_points(spark, sf_dir), 1000)


@query
def rolling_5min(spark, sf_dir):
    return mo.rolling_window(metric_points(spark, sf_dir))


@query
def metric_trend(spark, sf_dir):
    return mo.metric_trend(metric_points(spark, sf_dir))


@query
def recent_errors(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("log_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("level"), F.col("props").alias("message"))
    return mo.recent_errors(log)


@query
def throughput_series(spark, sf_dir):
    newest = mo.newest_points(metric_points(spark, sf_dir), 60)
    return newest.select("name", "timestamp", "point_id", F.col("value").cast("double").alias("value"), "recency")
