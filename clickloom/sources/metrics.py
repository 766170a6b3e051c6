"""The metrics table: points appended per date, read back inside their retention period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.operators.monitoring import retained
from clickloom.schema import HOUR_MS, METRIC_POINT
from clickloom.sources.silver import since


def put_points(points: DataFrame, path: str) -> None:
    """Append points; absent fields get their defaults (point 0, gauge, no dimensions, count)."""
    defaults = {"point_id": F.lit(0).cast("bigint"), "metric_type": F.lit("gauge"), "dimensions": F.create_map().cast("map<string,string>"), "unit": F.lit("count")}
    filled = points.select(*[
        F.coalesce(F.col(f.name), defaults[f.name]).alias(f.name) if f.name in points.columns and f.name in defaults
        else (F.col(f.name) if f.name in points.columns else defaults[f.name].alias(f.name))
        for f in METRIC_POINT.fields
    ])
    dated = filled.withColumn("event_date", F.to_date(F.timestamp_millis("timestamp")))
    dated.write.mode("append").partitionBy("event_date").parquet(path)


def read_points(spark: SparkSession, path: str, now_ms: Column, keep_ms: int = HOUR_MS) -> DataFrame:
    """Live points only; date partitions outside the period are not read."""
    table = spark.read.parquet(path)
    return retained(since(table, now_ms - keep_ms), now_ms, keep_ms)
