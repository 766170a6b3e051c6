"""Lines to silver: parse, quarantine, identify, deduplicate, enrich, append.

Lines are parsed once, into a bronze table that also holds when a line was seen and whether it is usable: one decision per
line, with one clock. Silver and the side tables read bronze. Ids are remembered by the time they were first seen, so no
event is late, whatever its own time says, and a line is in silver, in quarantine, or a copy of a line in silver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.clock import event_date
from clickloom.functions.identity import event_key
from clickloom.functions.money import revenue
from clickloom.operators.dedup import dedup
from clickloom.operators.enrich import enrich
from clickloom.operators.membership import build_bitmaps, new_ids
from clickloom.operators.parsing import parse_lines, quarantine_reason
from clickloom.schema import DAY_MS, DEDUP_TTL_MS, RAW_EVENT
from clickloom.sources.connectors import stream_lines


@dataclass(frozen=True)
class Tables:
    """Folders of one deployment."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def summaries(self) -> str:
        return f"{self.root}/summaries"

    @property
    def minutes(self) -> str:
        return f"{self.root}/minutes"

    @property
    def campaign_hours(self) -> str:
        return f"{self.root}/campaign_hours"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def horizon(allowed_ahead_ms: int) -> Column:
    """Latest acceptable event time."""
    return F.unix_millis(F.current_timestamp()) + allowed_ahead_ms


def parse_once(lines: DataFrame, allowed_ahead_ms: int = 8 * DAY_MS) -> DataFrame:
    """Bronze: the event's fields, line_class, reason (why it is quarantined), raw_line of quarantined lines, and seen_at."""
    reason = quarantine_reason(horizon(allowed_ahead_ms))
    return parse_lines(lines).withColumn("reason", reason).select(
        *RAW_EVENT.names, "line_class", "reason", F.when(F.col("reason").isNotNull(), F.col("raw_line")).alias("raw_line"),
        F.current_timestamp().alias("seen_at"))


def _sound(bronze: DataFrame) -> DataFrame:
    return bronze.where((F.col("line_class") == "event") & F.col("reason").isNull())


def drop_duplicates(events: DataFrame, ttl_ms: int = DEDUP_TTL_MS, copy_salts: int = 0) -> DataFrame:
    """Keep the first copy of an id for ``ttl_ms`` after it was first seen (``seen_at``, a processing time).

    The state of an id goes when the watermark, half a time to live behind the newest arrival, is another half past its
    first sight. Arrivals are never behind the watermark. ``copy_salts`` adds a first pass per (id, input partition): it costs a
    second state store, and is for feeds in which one id makes up a large part of a micro-batch.
    """
    timed = events.withWatermark("seen_at", f"{ttl_ms // 2} milliseconds")
    if copy_salts:
        salted = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(copy_salts)))
        timed = salted.dropDuplicatesWithinWatermark(["event_id", "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(["event_id"])


def silver_stream(bronze: DataFrame, ttl_ms: int = DEDUP_TTL_MS, copy_salts: int = 0) -> DataFrame:
    """Enriched, duplicate-free events of a bronze stream."""
    events = enrich(_sound(bronze), extra=("seen_at",))
    return drop_duplicates(events, ttl_ms, copy_salts).drop("seen_at").withColumn("event_date", event_date())


def silver_schema(spark: SparkSession):
    """The fixed schema of the silver table."""
    bronze = parse_once(spark.createDataFrame([], "value string"))
    return enrich(_sound(bronze)).withColumn("event_date", event_date()).schema


def summarize(bronze: DataFrame, batch_id: int, at: Column) -> DataFrame:
    """The processing record of one batch: counts, rates, latency, memory estimate and revenue.

    ``processed`` counts distinct events of the batch, ``deduped`` its further copies; ``duration`` is the time in seconds from the
    first line seen to ``at``. Rates are fractions; money is in dollars.
    """
    sound = (F.col("line_class") == "event") & F.col("reason").isNull()
    kind, at_ms = F.col("event_type"), F.unix_millis(at)

    def count(condition: Column) -> Column:
        return F.count_if(sound & condition)
    totals = bronze.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(sound).alias("_received"),
        F.count_distinct(F.when(sound, event_key())).alias("processed"),
        F.count_if(F.col("line_class") == "malformed").alias("errors"), F.count_if(F.col("reason").isNotNull()).alias("quarantined"),
        F.coalesce(F.sum(F.when(sound, revenue())), F.lit(0)).cast("decimal(38,4)").alias("revenue"),
        F.max(F.when(sound, F.col("timestamp"))).alias("last_timestamp"),
        ((at_ms - F.min(F.unix_millis("seen_at"))) / 1000).alias("duration"),
        F.coalesce(at_ms - F.avg(F.unix_millis("seen_at")), F.lit(0.0)).alias("avg_processing_latency_ms"),
        count(kind == "impression").alias("impressions_processed"), count(kind == "click").alias("clicks_processed"),
        count(kind == "conversion").alias("conversions_processed"),
        F.count_distinct(F.when(sound, F.col("campaign_id"))).alias("unique_campaigns"),
        F.count_distinct(F.when(sound, F.col("user_id"))).alias("unique_users"))
    processed = F.col("processed").cast("double")
    return totals.select(
        F.lit(batch_id).cast("bigint").alias("batch"), at_ms.alias("timestamp"), "lines", "quarantined", "processed", "errors",
        (F.col("_received") - F.col("processed")).alias("deduped"), F.coalesce("duration", F.lit(0.0)).alias("duration"), "revenue", "last_timestamp",
        F.col("processed").alias("events_processed"),
        (processed / F.greatest(F.coalesce("duration", F.lit(0.0)), F.lit(0.001))).alias("events_per_second"),
        ((F.col("_received") - F.col("processed")) / F.greatest(processed, F.lit(1.0))).alias("deduplication_rate"),
        (F.col("errors") / F.greatest(processed + F.col("errors"), F.lit(1.0))).alias("error_rate"),
        "avg_processing_latency_ms", (processed * 32 / (1 << 20)).alias("memory_usage_mb"),
        "impressions_processed", "clicks_processed", "conversions_processed", F.col("revenue").cast("double").alias("revenue_processed_usd"),
        "unique_campaigns", "unique_users")


def start_ingest(spark: SparkSession, source: Mapping, tables: Tables, *, ttl_ms: int = DEDUP_TTL_MS,
                 allowed_ahead_ms: int = 8 * DAY_MS, copy_salts: int = 0, trigger: Mapping | None = None) -> list[StreamingQuery]:
    """Start bronze, silver and the side tables. ``trigger`` is passed on; with ``{"availableNow": True}`` bronze ends first."""
    how = dict(trigger or {"processingTime": "10 seconds"})
    parsed = parse_once(stream_lines(spark, source), allowed_ahead_ms)
    _make_folder(spark, tables.bronze)
    bronze = (
        parsed.writeStream.queryName("bronze").format("parquet").outputMode("append")
        .option("path", tables.bronze).option("checkpointLocation", tables.checkpoint("bronze")).trigger(**how).start()
    )
    if how.get("availableNow") or how.get("once"):
        bronze.awaitTermination()
    schema = parsed.schema
    silver = (
        silver_stream(spark.readStream.schema(schema).parquet(tables.bronze), ttl_ms, copy_salts)
        .writeStream.queryName("silver").format("parquet").outputMode("append").partitionBy("event_date")
        .option("path", tables.silver).option("checkpointLocation", tables.checkpoint("silver"))
        .trigger(**how).start()
    )

    def side_tables(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.where("reason IS NOT NULL").select("raw_line", "reason").write.mode("overwrite").parquet(f"{tables.quarantine}/batch={batch_id}")
        summarize(batch, batch_id, F.current_timestamp()).drop("batch").write.mode("overwrite").parquet(f"{tables.summaries}/batch={batch_id}")
        batch.unpersist()

    side = (
        spark.readStream.schema(schema).parquet(tables.bronze)
        .writeStream.queryName("side_tables").foreachBatch(side_tables)
        .option("checkpointLocation", tables.checkpoint("side_tables"))
        .trigger(**how).start()
    )
    return [bronze, silver, side]


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def ingest_batch(events: DataFrame, path: str, batch_id: int, arrived_ms: int | None = None) -> DataFrame:
    """Add one batch of raw events to a batch-wise silver table and return its summary row.

    The table is partitioned by the day of arrival first (``arrived_ms``, now by default), and an id is known for seven days from
    its arrival, whatever the event's own time: those days' ids and bitmaps are read, and no others. Bitmaps of each batch's ids
    (``<path>_ids``) rule most new ids out before the exact comparison. Running a batch again replaces its own partitions
    and never sees them as earlier ones, so it is safe to retry; a retry belongs to the day of its first run.
    """
    spark = events.sparkSession
    if events.isEmpty():
        raise ValueError("empty event batch")
    bitmaps_path = f"{path}_ids"
    named = events.where(F.nullif(F.col("event_id"), F.lit("")).isNotNull() & F.col("timestamp").isNotNull())
    fresh = dedup(enrich(named))
    arrived = F.to_date(F.timestamp_millis(F.lit(arrived_ms)) if arrived_ms is not None else F.current_timestamp())
    if _exists(spark, path) and _exists(spark, bitmaps_path):
        again = spark.read.parquet(path).where(F.col("batch") == batch_id).select("arrival_date").first()
        arrived = F.lit(again.arrival_date) if again else arrived
        known_days = (F.col("batch") < batch_id) & (F.col("arrival_date") >= F.date_sub(arrived, DEDUP_TTL_MS // DAY_MS))
        seen = spark.read.parquet(path).where(known_days).select("event_id")
        bitmaps = spark.read.parquet(bitmaps_path).where(known_days)
        fresh = fresh.join(new_ids(fresh, seen, bitmaps), "event_id", "left_semi")
    (
        fresh.withColumns({"arrival_date": arrived, "batch": F.lit(batch_id), "event_date": event_date()})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("arrival_date", "batch", "event_date").parquet(path)
    )
    size = events.agg(F.count(F.lit(1))).scalar()
    written = spark.read.parquet(path).where(F.col("batch") == batch_id)
    (build_bitmaps(written.select("arrival_date", "event_id")).withColumn("batch", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("arrival_date", "batch").parquet(bitmaps_path))
    return written.agg(
        F.count(F.lit(1)).alias("processed"),
        F.coalesce(F.sum(revenue("first_nonzero")), F.lit(0)).cast("double").alias("total_revenue"),
    ).select(
        F.lit(batch_id).cast("bigint").alias("batch"), size.alias("batch_size"), "processed",
        (size - F.col("processed")).alias("duplicates"), F.lit(0).cast("bigint").alias("errors"), "total_revenue")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def progress_metrics(query: StreamingQuery) -> list[dict]:
    """Rows, rate and time of a query's recent micro-batches."""
    return [
        {"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"],
         "batch_ms": p["batchDuration"] if "batchDuration" in p else p["durationMs"]["triggerExecution"]}
        for p in query.recentProgress
    ]
