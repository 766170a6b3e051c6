"""Alarm states over a stream of metric points.

The state of an alarm depends only on its newest point, and a change only on the point before it. So no per-alarm
Python state is kept: every micro-batch runs the batch operator, continued from the states that the previous
batch stored, and writes changes and states into folders named after the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.alerts import evaluate, rules_table, state_changes
from clickloom.operators.monitoring import batch_metrics
from clickloom.schema import DEFAULT_RULES

_STATE = "alert_name string, state string, timestamp bigint, trigger_count bigint, last_triggered bigint"


def process_points(points: DataFrame, root: str, batch_id: int, rules=DEFAULT_RULES,
                   notify: Callable[[DataFrame], None] | None = None) -> None:
    """Handle one micro-batch of (name, point_id, timestamp, value). Safe to repeat for the same batch id."""
    spark = points.sparkSession
    before = (spark.read.schema(_STATE).parquet(f"{root}/states/batch={batch_id - 1}") if batch_id
              else spark.createDataFrame([], _STATE))
    judged = evaluate(points, rules_table(spark, rules))
    known = before.select("alert_name", F.col("timestamp").alias("_known_at"))
    current = judged.join(known, "alert_name", "left").where(
        F.col("_known_at").isNull() | (F.col("timestamp") >= F.col("_known_at"))).drop("_known_at")  # a late point changes no state
    changes = state_changes(current, before)
    changes.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    alarm = F.col("state") == "ALARM"
    newest = current.groupBy("alert_name").agg(F.max(F.struct("timestamp", "point_id", "state")).alias("_now"))
    triggers = judged.groupBy("alert_name").agg(
        F.count_if(alarm).alias("_triggers"), F.max(F.when(alarm, F.col("timestamp"))).alias("_triggered"))
    merged = before.join(newest, "alert_name", "full_outer").join(triggers, "alert_name", "full_outer").select(
        "alert_name",
        F.coalesce("_now.state", "state").alias("state"),
        F.coalesce("_now.timestamp", "timestamp").alias("timestamp"),
        (F.coalesce("trigger_count", F.lit(0)) + F.coalesce("_triggers", F.lit(0))).alias("trigger_count"),
        F.greatest("last_triggered", "_triggered").alias("last_triggered"))
    merged.write.mode("overwrite").parquet(f"{root}/states/batch={batch_id}")
    if notify is not None:
        notify(spark.read.parquet(f"{root}/changes/batch={batch_id}").where("notify"))


def start_alarms(points: DataFrame, root: str, rules=DEFAULT_RULES, notify: Callable[[DataFrame], None] | None = None,
                 trigger: Mapping | None = None) -> StreamingQuery:
    return (
        points.writeStream.queryName("alarms")
        .foreachBatch(lambda batch, batch_id: process_points(batch, root, batch_id, rules, notify))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**dict(trigger or {"processingTime": "10 seconds"})).start()
    )


def summary_points(summaries: DataFrame) -> DataFrame:
    """Metric points of batch summaries (batch, processed, errors, revenue, duration, last_timestamp)."""
    metrics = batch_metrics(summaries).join(summaries.select("batch", F.col("last_timestamp").alias("timestamp")), "batch")
    named = (("EventsProcessed", "events_processed"), ("EventsPerSecond", "events_per_second"),
             ("ProcessingLatency", "processing_latency_ms"), ("ErrorRate", "error_rate"),
             ("TotalRevenue", "total_revenue"), ("RevenuePerHour", "revenue_per_hour"))
    points = F.array(*[F.struct(F.lit(name).alias("name"), F.col(col).cast("double").alias("value")) for name, col in named])
    return metrics.select(F.col("batch").alias("point_id"), "timestamp", F.inline(points))
