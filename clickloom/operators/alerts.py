"""Threshold rules, alarm states and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.operators.ordered import slice_rows, with_previous
from clickloom.schema import DEFAULT_RULES, RULE, SUSTAINED_ALARMS

NO_DATA = "INSUFFICIENT_DATA"


def rules_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    """Rules listed in code, or a table of them as it is. Spark broadcasts what is small enough."""
    return rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), RULE)


def breaches(value: Column, comparison: Column, threshold: Column) -> Column:
    value = value.cast("double")
    return (
        F.when(comparison == "gt", value > threshold)
        .when(comparison == "lt", value < threshold)
        .when(comparison == "eq", F.abs(value - threshold) < 0.001)
        .otherwise(F.lit(False))
    )


def evaluate(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Every point against every enabled rule on its metric."""
    breach = breaches(F.col("value"), F.col("comparison"), F.col("threshold"))
    return (
        points.select(F.col("name").alias("metric_name"), "point_id", "timestamp", "value")
        .join(rules.where("enabled"), "metric_name")
        .select("alert_name", "metric_name", "level", "comparison", "threshold", "point_id", "timestamp", "value",
                F.when(breach, "ALARM").otherwise("OK").alias("state"))
    )


def reason(state: Column) -> Column:
    shown = F.concat(F.lit("Metric "), F.col("metric_name"), F.lit(" = "),
                     F.col("value").cast("decimal(20,2)").cast("string"))
    limit = F.concat(F.lit(" "), F.col("comparison"), F.lit(" "), F.col("threshold").cast("string"))
    return F.when(state == "ALARM", F.concat(shown, limit)).otherwise(shown)


def state_changes(evaluated: DataFrame, known_states: DataFrame | None = None) -> DataFrame:
    """Points at which an alarm changes state. ``known_states(alert_name, state)`` continues an earlier run."""
    ordered = slice_rows(evaluated, ["alert_name"], ["timestamp", "point_id"])
    changes = with_previous(ordered, "state", "_before")
    if known_states is not None:
        changes = changes.join(
            known_states.select("alert_name", F.col("state").alias("_known")), "alert_name", "left")
        changes = changes.withColumn("_before", F.coalesce("_before", "_known")).drop("_known")
    before = F.coalesce("_before", F.lit(NO_DATA))
    return changes.where(F.col("state") != before).select(
        "alert_name", "metric_name", "level", "point_id", "timestamp",
        F.col("value").cast("double").alias("value"),
        before.alias("old_state"), F.col("state").alias("new_state"),
        reason(F.col("state")).alias("reason"),
        (F.col("state") == "ALARM").alias("notify"))


def alarm_states(evaluated: DataFrame, rules: DataFrame) -> DataFrame:
    """Current state of every rule, and its trigger bookkeeping; rules without points lack data."""
    alarm = F.col("state") == "ALARM"
    newest = F.struct("timestamp", "point_id", "state", reason(F.col("state")).alias("reason"), "value")
    current = evaluated.groupBy("alert_name").agg(
        F.max(newest).alias("_now"), F.count_if(alarm).alias("_triggers"),
        F.max(F.when(alarm, F.col("timestamp"))).alias("_triggered"))
    return rules.join(current, "alert_name", "left").select(
        "alert_name", "metric_name", "level",
        F.coalesce("_now.state", F.lit(NO_DATA)).alias("state"),
        F.coalesce("_now.reason", F.lit("Alert just created")).alias("reason"),
        F.col("_now.timestamp").alias("timestamp"),
        F.col("_now.value").cast("double").alias("metric_value"),
        F.coalesce("_triggers", F.lit(0)).alias("trigger_count"),
        F.col("_triggered").alias("last_triggered"))


def overall_health(states: DataFrame) -> DataFrame:
    active = F.col("state") == "ALARM"
    severe = F.count_if(active & F.col("level").isin("critical", "emergency"))
    mild = F.count_if(active & (F.col("level") == "warning"))
    return states.agg(
        F.when(severe > 0, "CRITICAL").when(mild > 0, "WARNING").otherwise("HEALTHY").alias("overall_status"),
        F.count_if(active).alias("active_alerts"))


def active_alerts(states: DataFrame) -> DataFrame:
    return states.where(F.col("state") == "ALARM").select(
        "alert_name", "state", "level", "reason", "last_triggered")


def dashboard_alerts(states: DataFrame) -> DataFrame:
    """Every alert as a dashboard lists it, also those that are quiet or lack data."""
    return states.select("alert_name", "state", "reason", "level", "last_triggered")


def system_health(states: DataFrame, points: DataFrame, start_ms: Column, now_ms: Column) -> DataFrame:
    """One row: overall status, number of active alerts, and the events processed from ``start_ms`` to now."""
    counted = points.where((F.col("name") == "EventsProcessed") & F.col("timestamp").between(start_ms, now_ms))
    processed = counted.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("double")).scalar()
    return overall_health(states).select("overall_status", "active_alerts", processed.alias("total_events_processed"))


def sustained_alarms(points: DataFrame, period_ms: int = 300_000, alarms=SUSTAINED_ALARMS) -> DataFrame:
    """Periods in which a mean has breached for the required number of adjoining periods.

    Points fold to one row per metric and period before any window is taken.
    """
    spark = points.sparkSession
    listed = F.broadcast(spark.createDataFrame(
        list(alarms), "alert_name string, name string, comparison string, threshold double, periods int"))
    means = points.groupBy("name", F.floor(F.col("timestamp") / period_ms).alias("period")).agg(
        (F.sum(F.col("value").cast("decimal(20,4)")).cast("double") / F.count("value").cast("double")).alias("mean"))
    judged = means.join(listed, "name").withColumn(
        "_breach", breaches(F.col("mean"), F.col("comparison"), F.col("threshold")))
    # Adjoining breaching periods share (period - rank among breaches).
    bad = judged.where("_breach")
    by_alarm = Window.partitionBy("alert_name").orderBy("period")
    runs = bad.withColumn("_run", F.col("period") - F.row_number().over(by_alarm))
    in_run = Window.partitionBy("alert_name", "_run").orderBy("period")
    return (
        runs.withColumn("breaching_periods", F.row_number().over(in_run))
        .where(F.col("breaching_periods") >= F.col("periods"))
        .select("alert_name", "period", "mean", F.col("breaching_periods").cast("bigint").alias("breaching_periods"))
    )


def campaign_alerts(metrics: DataFrame, rules: DataFrame, now_ms: Column) -> DataFrame:
    """Evaluate per-campaign rules (campaign_id, metric, comparison, threshold) on campaign metrics."""
    measured = metrics.select("campaign_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("revenue_usd", "ctr", "conversion_rate", "clicks")])))
    return rules.join(measured, ["campaign_id", "metric"]).select(
        F.concat(F.lit("alert_"), F.col("campaign_id"), F.lit("_"), F.floor(now_ms / 1000).cast("string")).alias("alert_id"),
        "campaign_id", "metric", "comparison", "threshold", "value",
        F.when(breaches(F.col("value"), F.col("comparison"), F.col("threshold")), "ALARM").otherwise("OK").alias("state"))


def health_summary(states: DataFrame, dashboard: DataFrame) -> DataFrame:
    """One row: status, active alerts and the current key metrics."""
    def current(metric: str, name: str) -> Column:
        return F.max(F.when(F.col("name") == metric, F.col("current"))).alias(name)
    figures = dashboard.agg(
        current("EventsPerSecond", "events_per_second"), current("ProcessingLatency", "processing_latency_ms"),
        current("ErrorRate", "error_rate"), current("CPUUtilization", "cpu_usage"),
        current("MemoryUtilization", "memory_usage"))
    health = overall_health(states).select(F.struct("overall_status", "active_alerts")).scalar()
    status = health["overall_status"]
    return figures.select(
        F.when(status.isin("HEALTHY", "WARNING"), "healthy").otherwise("unhealthy").alias("status"),
        status.alias("overall_status"), health["active_alerts"].alias("active_alerts"), "*")
