"""Keyed storage: key derivation, upsert content, partitioned writes and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.clock import event_date
from clickloom.functions.identity import partition_key, sort_key
from clickloom.operators.dedup import latest_by_key
from clickloom.schema import RETENTION_SECONDS
from clickloom.session import cut_lineage, shuffle_slices
from clickloom.sources.silver import day_column

EVENT_TTL_SECONDS = dict(RETENTION_SECONDS)["events"]


def keyed(events: DataFrame, now_ms: Column) -> DataFrame:
    """Add the table's two keys and the expiry second."""
    return events.withColumns({
        "partition_key": partition_key(),
        "sort_key": sort_key(),
        "ttl": F.floor(now_ms / 1000) + EVENT_TTL_SECONDS,
    })


def upserted(events: DataFrame, now_ms: Column) -> DataFrame:
    """Content of the keyed table after all writes: the last delivery under a key wins."""
    return latest_by_key(keyed(events, now_ms), ["partition_key", "sort_key"], ["ingest_seq"])


def live(events: DataFrame, now_ms: Column, days: int = EVENT_TTL_SECONDS // 86400) -> DataFrame:
    """Events inside the retention period, by whole UTC days, so that old date partitions are never read."""
    first_day = F.date_sub(F.to_date(F.timestamp_millis(now_ms)), days)
    return events.where(day_column(events) >= first_day)


def retention_report(events: DataFrame, now_ms: Column) -> DataFrame:
    """How many rows every retention policy would keep, from one pass over the rows."""
    age = now_ms - F.col("timestamp")
    counts = events.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(age <= seconds * 1000).alias(policy) for policy, seconds in RETENTION_SECONDS],
    )
    policies = F.array(*[
        F.struct(F.lit(policy).alias("policy"), F.lit(seconds).cast("bigint").alias("ttl_seconds"),
                 F.col(policy).alias("live_rows"), (F.col("rows") - F.col(policy)).alias("expired_rows"))
        for policy, seconds in RETENTION_SECONDS
    ])
    return counts.select(F.inline(policies))


def write_silver(events: DataFrame, path: str, partitions: int | None = None) -> None:
    """Replace the touched ``event_date`` partitions.

    Rows are cut into ranges of (date, campaign, time): a lookup of a campaign and day opens few files, row-group
    statistics are narrow, and a busy day or campaign is spread over as many tasks as its share of the rows asks for.
    """
    order = ["event_date", "campaign_id", "timestamp", "event_id"]
    dated = events.withColumn("event_date", event_date())
    (
        dated.repartitionByRange(partitions or shuffle_slices(events.sparkSession), *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date").parquet(path)
    )


def upsert_keyed(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch into the keyed table: rewrite only the dates it touches, the last arrival under a key wins.

    The table holds both keys, the expiry, and when a row was written (batch and place in it), so a repeated batch replaces
    itself. It may start empty. The current content of the touched dates is read with a semi join on the date partition, and the
    merged rows are checkpointed before the overwrite, since a table must not be replaced while it is being read.
    """
    spark = batch.sparkSession
    now_ms = F.unix_millis(F.current_timestamp())
    numbered = batch.drop("event_date").withColumns({
        "_place": F.monotonically_increasing_id(), "written_batch": F.lit(batch_id).cast("bigint")})
    fresh = cut_lineage(keyed(numbered, now_ms).withColumn("event_date", event_date()).withColumnRenamed("_place", "written_place"))
    merged = fresh
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        dates = fresh.select("event_date").distinct()
        current = spark.read.schema(fresh.schema).parquet(path).join(dates, "event_date", "left_semi")
        merged = current.where(F.col("written_batch") != batch_id).unionByName(fresh)
    last = latest_by_key(merged, ["event_date", "partition_key", "sort_key"], ["written_batch", "written_place"])
    write_silver(cut_lineage(last.drop("event_date")), path)
