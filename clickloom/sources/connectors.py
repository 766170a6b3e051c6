"""Configured sources and sinks.

A configuration names a type (file by default, in any letter case): ``file`` for JSON-lines folders, ``kinesis`` for a
stream connector on the cluster's class path, ``dynamodb`` for the keyed event table, which is kept as Parquet.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from clickloom.functions.identity import event_key
from clickloom.sources.growing import follow

# Fixed values here and in the settings below: source types, names of variables, default names and paths.
TYPES = ("file", "kinesis", "dynamodb")


def source_type(config: Mapping) -> str:
    kind = str(config.get("type", "file")).lower()
    if kind not in TYPES:
        raise ValueError(f"unsupported data source type: {kind}")
    return kind


def _stream_options(config: Mapping) -> dict[str, str]:
    options = {"streamName": config["stream_name"], "region": config.get("region", "us-east-1"),
               "startingPosition": config.get("starting_position", "TRIM_HORIZON")}
    if config.get("endpoint_url"):
        options["endpointUrl"] = config["endpoint_url"]
    return options


def input_config(env: Mapping[str, str] = os.environ) -> dict:
    """Input settings from environment variables."""
    if env.get("USE_KINESIS", "false").lower() == "true":
        return {"type": "kinesis", "stream_name": env.get("KINESIS_STREAM_NAME", "ad-events-stream"),
                "region": env.get("AWS_REGION", "us-east-1"), "endpoint_url": env.get("KINESIS_ENDPOINT_URL")}
    return {"type": "file", "file_path": env.get("INPUT_FILE_PATH", "/app/data/raw_ad_events.jsonl")}


def output_config(env: Mapping[str, str] = os.environ) -> dict:
    """Output settings from environment variables."""
    region = env.get("AWS_REGION", "us-east-1")
    if env.get("USE_DYNAMODB", "false").lower() == "true":
        return {"type": "dynamodb", "region": region, "file_path": env.get("OUTPUT_FILE_PATH", "/app/data/keyed_events")}
    if env.get("USE_KINESIS_OUTPUT", "false").lower() == "true":
        return {"type": "kinesis", "stream_name": env.get("KINESIS_OUTPUT_STREAM", "ad-events-processed-stream"),
                "region": region, "endpoint_url": env.get("KINESIS_ENDPOINT_URL")}
    return {"type": "file", "file_path": env.get("OUTPUT_FILE_PATH", "/app/data/processed_ad_events.jsonl")}


def read_lines(spark: SparkSession, config: Mapping) -> DataFrame:
    """All lines of a file source, one ``value`` per row."""
    if source_type(config) != "file":
        raise ValueError("only file sources can be read as a batch")
    reader = spark.read.format("text")
    if config.get("pattern"):
        reader = reader.option("pathGlobFilter", config["pattern"])
    return reader.load(config["file_path"])


def _is_file(config: Mapping) -> bool:
    return not config.get("pattern") and bool(os.path.splitext(config["file_path"])[1])


def stream_lines(spark: SparkSession, config: Mapping) -> DataFrame:
    """A stream of lines; all shards of a stream are read.

    A file path that names a single file (it has a suffix and no ``pattern`` is set), or ``follow`` in the configuration, is
    followed by byte offsets as it grows and is rotated. Files of other folders must arrive whole, under new names.
    """
    kind = source_type(config)
    if kind == "file" and config.get("follow", _is_file(config)):
        return follow(spark, config["file_path"], config.get("pattern"), **config.get("follow_options", {}))
    if kind == "file":
        reader = spark.readStream.format("text").option("maxFilesPerTrigger", config.get("max_files_per_trigger", 1000))
        if config.get("pattern"):
            reader = reader.option("pathGlobFilter", config["pattern"])
        return reader.load(config["file_path"])
    if kind == "kinesis":
        reader = spark.readStream.format(config.get("format", "kinesis")).options(**_stream_options(config))
        return reader.load().select(F.col("data").cast("string").alias("value"))
    raise ValueError("the keyed table is a sink; read its Parquet files instead")


def stream_records(events: DataFrame) -> DataFrame:
    """Events as (partitionKey, data) records: keyed by user, else by event. The service spreads them by key."""
    user = F.nullif(F.col("user_id"), F.lit(""))
    return events.select(F.coalesce(user, event_key()).alias("partitionKey"),
                         F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("data"))


def append_events(events: DataFrame, path: str, layout: str = "json") -> None:
    """Append as JSON lines (or any built-in file format)."""
    events.write.mode("append").format(layout).save(path)


def write_stream(events: DataFrame, config: Mapping, checkpoint: str) -> DataStreamWriter:
    """A writer for the configured sink; the caller sets the trigger and starts it."""
    kind = source_type(config)
    if kind == "file":
        return (events.writeStream.format(config.get("format", "json")).outputMode("append")
                .option("path", config["file_path"]).option("checkpointLocation", checkpoint))
    if kind == "kinesis":
        return (stream_records(events).writeStream.format(config.get("format", "kinesis")).outputMode("append")
                .options(**_stream_options(config)).option("checkpointLocation", checkpoint))
    from clickloom.operators.layout import upsert_keyed

    path = config["file_path"]
    return (events.writeStream.foreachBatch(lambda batch, batch_id: upsert_keyed(batch, path, batch_id))
            .option("checkpointLocation", checkpoint))


def source_metrics(events: DataFrame, config: Mapping) -> DataFrame:
    """Type, location, rows and newest event of a source."""
    where = config.get("stream_name") or config.get("file_path")
    return events.agg(F.count(F.lit(1)).alias("events_written"), F.max("timestamp").alias("last_write_time")).select(
        F.lit(source_type(config)).alias("type"), F.lit(where).alias("location"), "events_written", "last_write_time")
