"""Streamed state that is no sum: distinct users and percentiles of any span, without reading events or points again.

Every micro-batch writes what it adds as rows that merge: sets of users per hour and campaign (rows, exactly once each when
merged), and quantile sketches per metric and minute. A repeated batch replaces its own folder; batches come in any order of event
time, so nothing is late. Reading merges the rows of a span; compaction merges the batches that the stream has committed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.schema import HOUR_MS
from clickloom.streaming.gold import _committed, _compacted_to
from clickloom.streaming.ingest import Tables, _make_folder, silver_schema

MINUTE_MS = 60_000
#: Size of a sketch: a percentile's rank is off by about 0.4 % at most, and exact while a span has fewer points than this.
SKETCH_SIZE = 1024
GRAINS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}

Merge = Callable[[DataFrame], DataFrame]


def user_rows(events: DataFrame) -> DataFrame:
    """(hour, campaign_id, user_id) once each. Events without a user have none; those without a campaign count under null."""
    user = F.nullif(F.col("user_id"), F.lit(""))
    return events.where(user.isNotNull()).select(
        F.floor(F.col("timestamp") / HOUR_MS).alias("hour"), "campaign_id", "user_id").distinct()


def sketch_rows(points: DataFrame) -> DataFrame:
    """(name, minute, sketch, samples, total) of metric points."""
    value = F.col("value").cast("double")
    return points.where(value.isNotNull()).groupBy("name", F.floor(F.col("timestamp") / MINUTE_MS).alias("minute")).agg(
        F.kll_sketch_agg_double(value, SKETCH_SIZE).alias("sketch"), F.count("*").alias("samples"), F.sum(value).alias("total"))


def merge_users(rows: DataFrame) -> DataFrame:
    return rows.distinct()


def merge_sketches(rows: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("name", "minute")
    return rows.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"), F.sum("samples").alias("samples"),
                                   F.sum("total").alias("total"))


def add_batch(rows: DataFrame, path: str, batch_id: int, order: str) -> None:
    """Write a batch's rows, sorted by time, so that a span reads few row groups."""
    rows.sortWithinPartitions(order).write.mode("overwrite").parquet(f"{path}/partial/batch={batch_id}")


def stored(spark: SparkSession, path: str, last_batch: int | None = None) -> DataFrame:
    """The rows so far, to be merged: the newest compacted ones and those of later batches."""
    partial, upto = spark.read.parquet(f"{path}/partial"), _compacted_to(spark, path)
    if last_batch is not None:
        partial = partial.where(F.col("batch") <= last_batch)
    if upto is not None:
        partial = partial.where(F.col("batch") > upto)
    rows = partial.drop("batch")
    return rows if upto is None else rows.unionByName(spark.read.parquet(f"{path}/whole/upto={upto}"))


def compact(spark: SparkSession, path: str, checkpoint: str, merge: Merge, order: str) -> int | None:
    """Merge all batches that the stream has committed into one folder, in ranges of time, and return the last of them."""
    upto = _committed(spark, path, checkpoint)
    if upto is not None and upto != _compacted_to(spark, path):
        merge(stored(spark, path, upto)).repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(
            f"{path}/whole/upto={upto}")
    return upto


def _within(unit_ms: int, column: str, first_ms: int | None, last_ms: int | None) -> Column:
    """Whole units that a span of instants touches; it should begin and end on their bounds."""
    inside = F.lit(True)
    if first_ms is not None:
        inside = inside & (F.col(column) >= first_ms // unit_ms)
    if last_ms is not None:
        inside = inside & (F.col(column) <= last_ms // unit_ms)
    return inside


def unique_users(spark: SparkSession, path: str, grain: str | None = "hour", *, by_campaign: bool = True, first_ms: int | None = None,
                 last_ms: int | None = None) -> DataFrame:
    """Exact distinct users per hour, day or month (or over the whole span, with ``grain`` None), by campaign or over all.

    Users of several hours are merged before they are counted, so that none counts twice; a hot campaign spreads by its users.
    """
    rows = stored(spark, path).where(_within(HOUR_MS, "hour", first_ms, last_ms))
    keys = ["campaign_id"] if by_campaign else []
    if grain is not None:
        rows = rows.withColumn("bucket", F.date_format(F.timestamp_millis(F.col("hour") * HOUR_MS), GRAINS[grain]))
        keys = ["bucket", *keys]
    return rows.select(*keys, "user_id").distinct().groupBy(*keys).agg(F.count("*").alias("unique_users"))


def percentiles(spark: SparkSession, path: str, *, first_ms: int | None = None, last_ms: int | None = None,
                points: Mapping[str, float] | None = None) -> DataFrame:
    """Samples, mean and percentiles (50, 95, 99 unless named) of every metric over a span of whole minutes."""
    wanted = dict(points or {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    rows = stored(spark, path).where(_within(MINUTE_MS, "minute", first_ms, last_ms))
    whole = merge_sketches(rows, "name")
    return whole.select("name", "samples", (F.col("total") / F.col("samples")).alias("mean"),
                        *[F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias(name) for name, rank in wanted.items()])


def _start(rows: DataFrame, build: Merge, path: str, checkpoint: str, name: str, order: str, trigger: Mapping | None) -> StreamingQuery:
    return (rows.writeStream.queryName(name)
            .foreachBatch(lambda batch, batch_id: add_batch(build(batch), path, batch_id, order))
            .option("checkpointLocation", checkpoint).trigger(**dict(trigger or {"processingTime": "1 minute"})).start())


def start_users(spark: SparkSession, tables: Tables, *, trigger: Mapping | None = None) -> StreamingQuery:
    """Keep the users of every hour and campaign under ``<root>/users``."""
    _make_folder(spark, tables.silver)
    silver = spark.readStream.schema(silver_schema(spark)).parquet(tables.silver)
    return _start(silver, user_rows, f"{tables.root}/users", tables.checkpoint("users"), "users", "hour", trigger)


def start_percentiles(points: DataFrame, path: str, checkpoint: str, *, trigger: Mapping | None = None) -> StreamingQuery:
    """Keep a sketch for every metric and minute of a stream of points (name, timestamp, value)."""
    return _start(points, sketch_rows, path, checkpoint, "percentiles", "minute", trigger)
