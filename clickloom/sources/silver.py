"""The silver table as a source: dated Parquet, duplicate-free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SILVER_SETTING = "spark.clickloom.silver"


def silver_table(spark: SparkSession) -> DataFrame | None:
    """The table that the session's ``spark.clickloom.silver`` setting names, if any."""
    path = spark.conf.get(SILVER_SETTING, None)
    return spark.read.parquet(path) if path else None


def day_column(df: DataFrame) -> Column:
    """The partition column where there is one, so that date predicates prune; else the date of the event time."""
    if "event_date" in df.columns:
        return F.col("event_date")
    return F.to_date(F.timestamp_millis("timestamp"))


def since(df: DataFrame, from_ms: Column) -> DataFrame:
    """Rows at or after an instant; on a dated table the date partitions before it are not read."""
    recent = df.where(F.col("timestamp") >= from_ms)
    if "event_date" in df.columns:
        recent = recent.where(F.col("event_date") >= F.to_date(F.timestamp_millis(from_ms)))
    return recent
