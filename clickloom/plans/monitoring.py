"""Metric statistics, alerting and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions.clock import as_of
from clickloom.operators import alerts as al, campaigns as ca, monitoring as mo
from clickloom.plans.common import events, now, registrar
from clickloom.schema import DAY_MS
from clickloom.sources.adapter import metric_points
from clickloom.streaming.alarms import summary_points

QUERIES: dict = {}
query = registrar(QUERIES)


def _batches(spark, sf_dir):
    return mo.batch_summaries(events(spark, sf_dir, "timestamp", "event_type", "revenue_usd", "conversion_value_usd"))


def _evaluated(spark, sf_dir):
    return al.evaluate(metric_points(spark, sf_dir), al.rules_table(spark))


def _states(spark, sf_dir):
    return al.alarm_states(_evaluated(spark, sf_dir), al.rules_table(spark))


@query
def batch_metrics(spark, sf_dir):
    return mo.batch_metrics(_batches(spark, sf_dir))


@query
def metric_statistics(spark, sf_dir):
    points = metric_points(spark, sf_dir)
    end = as_of(points)
    return mo.metric_statistics(points, end - 7 * DAY_MS, end)


@query
def dashboard_metrics(spark, sf_dir):
    points = metric_points(spark, sf_dir)
    return mo.dashboard_metrics(points, as_of(points))


@query
def latency_summary(spark, sf_dir):
    return mo.latency_summary(metric_points(spark, sf_dir))


@query
def alert_evaluation(spark, sf_dir):
    return _evaluated(spark, sf_dir).select(
        "alert_name", "metric_name", "level", "point_id", "timestamp",
        F.col("value").cast("double").alias("value"), "state")


@query
def alert_transitions(spark, sf_dir):
    return al.state_changes(_evaluated(spark, sf_dir))


@query
def alarm_current(spark, sf_dir):
    return _states(spark, sf_dir)


@query
def overall_health(spark, sf_dir):
    return al.overall_health(_states(spark, sf_dir))


@query
def active_alerts(spark, sf_dir):
    return al.active_alerts(_states(spark, sf_dir))


@query
def dashboard_alerts(spark, sf_dir):
    return al.dashboard_alerts(_states(spark, sf_dir))


@query
def dashboard_health(spark, sf_dir):
    """Events processed come as points from the processing records of the batches."""
    records = summary_points(_batches(spark, sf_dir))
    return al.system_health(_states(spark, sf_dir), records, F.lit(0), as_of(records))


@query
def sustained_alarms(spark, sf_dir):
    return al.sustained_alarms(metric_points(spark, sf_dir))


@query
def tiered_status(spark, sf_dir):
    return mo.tiered_status(metric_points(spark, sf_dir))


@query
def heartbeat(spark, sf_dir):
    points = metric_points(spark, sf_dir)
    return mo.heartbeat(points, as_of(points))


@query
def campaign_alerts(spark, sf_dir):
    """Two rules for every campaign: conversion rate below 0.4, revenue above 2,000."""
    read = events(spark, sf_dir, "timestamp", "user_id", "campaign_id", "event_type", "revenue_usd", "conversion_value_usd")
    metrics = ca.campaign_performance_range(read, "2024-01-01", "2024-01-31")
    rules = read.select("campaign_id").distinct().select("campaign_id", F.inline(F.array(
        F.struct(F.lit("conversion_rate").alias("metric"), F.lit("lt").alias("comparison"), F.lit(0.4).alias("threshold")),
        F.struct(F.lit("revenue_usd").alias("metric"), F.lit("gt").alias("comparison"), F.lit(2000.0).alias("threshold")))))
    return al.campaign_alerts(metrics, rules, now(spark, sf_dir))


@query
def performance_grade(spark, sf_dir):
    return mo.performance_grade(mo.hourly_performance(metric_points(spark, sf_dir)))


@query
def health_summary(spark, sf_dir):
    return al.health_summary(_states(spark, sf_dir), dashboard_metrics(spark, sf_dir))


@query
def consumer_status(spark, sf_dir):
    return mo.consumer_status(_batches(spark, sf_dir))
