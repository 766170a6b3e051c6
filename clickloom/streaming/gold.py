"""Pre-aggregated tables kept from the silver stream, and their exact refresh."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.clock import BUCKET_PATTERNS, event_time
from clickloom.functions.money import revenue
from clickloom.operators.campaigns import campaign_metrics_bucketed, campaign_metrics_today, type_counts
from clickloom.streaming.ingest import Tables, _make_folder, silver_schema


def _windowed(events: DataFrame, length: str, *keys: str) -> DataFrame:
    grouped = events.groupBy(F.window("event_ts", length), *keys).agg(
        F.count(F.lit(1)).alias("events"), *type_counts(), F.sum(revenue()).alias("revenue"))
    return grouped.select(
        F.col("window.start").alias("window_start"), *keys, "events", "impressions", "clicks", "conversions", "revenue",
        F.to_date("window.start").alias("event_date"))


def minute_windows(events: DataFrame) -> DataFrame:
    return _windowed(events, "1 minute")


def campaign_hour_windows(events: DataFrame) -> DataFrame:
    return _windowed(events.where(F.col("campaign_id").isNotNull()), "1 hour", "campaign_id")


def sliding_hour(events: DataFrame, every: str = "5 minutes") -> DataFrame:
    """The last hour, renewed every few minutes."""
    grouped = events.groupBy(F.window("event_ts", "1 hour", every)).agg(
        F.count(F.lit(1)).alias("events"), F.sum(revenue()).alias("revenue"))
    return grouped.select(F.col("window.end").alias("as_of"), "events", "revenue")


_SUMS = ("events", "impressions", "clicks", "conversions", "revenue")


def start_gold(spark: SparkSession, tables: Tables, *, trigger: Mapping | None = None) -> list[StreamingQuery]:
    """Keep minute and campaign-hour counters as partial sums: one folder per micro-batch, summed when read.

    The counters are additive, so no window is ever closed and no event is late; a repeated batch replaces its own folder.
    """
    how = dict(trigger or {"processingTime": "1 minute"})
    _make_folder(spark, tables.silver)
    schema, queries = silver_schema(spark), []
    for name, path, build in (("minutes", tables.minutes, minute_windows),
                              ("campaign_hours", tables.campaign_hours, campaign_hour_windows)):
        def add(batch: DataFrame, batch_id: int, path=path, build=build) -> None:
            build(batch.withColumn("event_ts", event_time())).write.mode("overwrite").parquet(f"{path}/partial/batch={batch_id}")

        queries.append(
            spark.readStream.schema(schema).parquet(tables.silver).writeStream.queryName(name).foreachBatch(add)
            .option("checkpointLocation", tables.checkpoint(name)).trigger(**how).start())
    return queries


def _compacted_to(spark: SparkSession, path: str) -> int | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/whole/upto=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    return max((int(f.getPath().getParent().getName().removeprefix("upto=")) for f in found or []), default=None)


def read_gold(spark: SparkSession, path: str, last_batch: int | None = None) -> DataFrame:
    """The counters so far (or up to a batch): the newest compacted sums plus the partial sums of later batches."""
    partial = spark.read.parquet(f"{path}/partial")
    if last_batch is not None:
        partial = partial.where(F.col("batch") <= last_batch)
    upto = _compacted_to(spark, path)
    if upto is not None:
        whole = spark.read.parquet(f"{path}/whole/upto={upto}")
        partial = partial.where(F.col("batch") > upto).drop("batch").unionByName(whole)
    keys = [c for c in partial.columns if c not in (*_SUMS, "batch")]
    return partial.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def _committed(spark: SparkSession, path: str, checkpoint: str) -> int | None:
    """The last batch that the stream has committed and whose partial sums are whole."""
    def numbers(pattern: str) -> list[str]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
        return [str(f.getPath()) for f in found or []]

    done = {int(p.rsplit("/", 1)[1]) for p in numbers(f"{checkpoint}/commits/*") if p.rsplit("/", 1)[1].isdigit()}
    whole = {int(p.rsplit("batch=", 1)[1].split("/")[0]) for p in numbers(f"{path}/partial/batch=*/_SUCCESS")}
    return max(done & whole, default=None)


def compact_gold(spark: SparkSession, path: str, checkpoint: str) -> int | None:
    """Sum all committed batches into one folder and return the last of them. Old folders may then be deleted.

    A batch that is being written, or that would be written again after a failure, is not in the stream's commit log yet:
    its part stays a partial sum, however much of it is there. The next compaction takes it.
    """
    upto = _committed(spark, path, checkpoint)
    if upto is not None and upto != _compacted_to(spark, path):
        read_gold(spark, path, upto).write.mode("overwrite").parquet(f"{path}/whole/upto={upto}")
    return upto


def refresh_gold(spark: SparkSession, tables: Tables, target: Tables, first_day: str, last_day: str) -> None:
    """Recompute whole days from silver into ``target``, replacing just those days' partitions."""
    days = F.col("event_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    silver = spark.read.parquet(tables.silver).where(days).withColumn("event_ts", event_time())
    for path, build in ((target.minutes, minute_windows), (target.campaign_hours, campaign_hour_windows)):
        (build(silver).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date").parquet(path))


def write_campaign_metrics(silver: DataFrame, path: str) -> None:
    """Keep campaign metrics per hour, day and month, one folder per grain, sorted for lookups by campaign."""
    metrics = campaign_metrics_bucketed(silver)
    order = ["time_period", "campaign_id", "time_bucket"]
    (metrics.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("time_period").parquet(path))


def campaign_metrics(spark: SparkSession, gold_path: str, silver: DataFrame, campaign_id: str, now_ms: Column,
                     time_period: str = "hour") -> DataFrame:
    """A campaign's metrics for the current hour, day or month: the stored row, else the day's figures from silver.

    The fallback reads one campaign and one date of silver, and yields a row only when nothing is stored.
    """
    if time_period not in BUCKET_PATTERNS:
        raise ValueError("time_period must be hour, day or month")
    figures = ["impressions", "clicks", "conversions", "revenue_usd", "unique_users", "ctr", "conversion_rate"]
    bucket = F.date_format(F.timestamp_millis(now_ms), BUCKET_PATTERNS[time_period])
    stored = spark.read.parquet(gold_path).where(
        (F.col("time_period") == time_period) & (F.col("campaign_id") == campaign_id) & (F.col("time_bucket") == bucket))
    computed = campaign_metrics_today(silver.where(F.col("campaign_id") == campaign_id), now_ms)
    absent = stored.agg(F.count(F.lit(1))).scalar() == 0
    return stored.select("campaign_id", *figures, F.lit("stored").alias("origin")).unionByName(
        computed.where(absent).select("campaign_id", *figures, F.lit("computed").alias("origin")))
