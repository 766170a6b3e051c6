"""Compaction of the streamed silver table, with snapshots that readers can hold on to.

The stream appends small files in order of arrival. Compaction rewrites the files of busy days into larger ones, cut by ranges
of (campaign, time), into a folder of its own, and then publishes a manifest: the files that are valid now with their ranges of
campaign and time, and the stream's files that they stand for. A manifest appears whole, by one rename; a reader takes one
manifest, the files in it, and the stream's files that it does not cover. So reads before, during and after a compaction are
whole, every row comes once, and a lookup opens only the files whose ranges hold what it looks for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.streaming.ingest import Tables, silver_schema

FILE_BYTES = 128 << 20
#: A day is rewritten when more files than this have been added to it.
SMALL_FILES = 8

_ENTRY = ("kind string, path string, event_date date, bytes long, rows long, low_campaign string, high_campaign string, any_null boolean, "
          "low_time long, high_time long")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(tables: Tables) -> str:
    return f"{tables.root}/silver_manifest"


def versions(spark: SparkSession, tables: Tables) -> list[int]:
    """Numbers of the published manifests, in order."""
    found = _files(spark, tables.root).globStatus(_path(spark, f"{_manifests(tables)}/version=*"))
    return sorted(int(f.getPath().getName().removeprefix("version=")) for f in found or [])


def _manifest(spark: SparkSession, tables: Tables, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).parquet(f"{_manifests(tables)}/version={version}")


def _latest(spark: SparkSession, tables: Tables) -> int | None:
    return max(versions(spark, tables), default=None)


def _streamed(spark: SparkSession, tables: Tables, manifest: DataFrame) -> list[str]:
    """The committed files of the stream that a manifest does not cover. File names only; the file index holds them anyway."""
    covered = {r.path for r in manifest.where("kind = 'covered'").select("path").collect()}
    return [f for f in spark.read.schema(silver_schema(spark)).parquet(tables.silver).inputFiles() if f not in covered]


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    schema = silver_schema(spark)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def _holds(campaign_id: str | None, first_ms: int | None, last_ms: int | None) -> tuple[Column, Column]:
    """What a lookup asks of a file's ranges, and of its rows."""
    files, rows = F.lit(True), F.lit(True)
    if campaign_id is not None:
        files = files & F.lit(campaign_id).between(F.col("low_campaign"), F.col("high_campaign"))
        rows = rows & (F.col("campaign_id") == campaign_id)
    if first_ms is not None:
        files, rows = files & (F.col("high_time") >= first_ms), rows & (F.col("timestamp") >= first_ms)
        day = F.to_date(F.timestamp_millis(F.lit(first_ms)))
        files, rows = files & (F.col("event_date") >= day), rows & (F.col("event_date") >= day)
    if last_ms is not None:
        files, rows = files & (F.col("low_time") <= last_ms), rows & (F.col("timestamp") <= last_ms)
        day = F.to_date(F.timestamp_millis(F.lit(last_ms)))
        files, rows = files & (F.col("event_date") <= day), rows & (F.col("event_date") <= day)
    return files, rows


def read_snapshot(spark: SparkSession, tables: Tables, *, campaign_id: str | None = None, first_ms: int | None = None,
                  last_ms: int | None = None, version: int | None = None) -> DataFrame:
    """Silver as of now: the files of one manifest (the newest, unless a version is given) and what the stream added since.

    A campaign and a span of time choose files by the manifest, then rows.
    """
    manifest = _manifest(spark, tables, _latest(spark, tables) if version is None else version)
    files, rows = _holds(campaign_id, first_ms, last_ms)
    chosen = [r.path for r in manifest.where((F.col("kind") == "file") & files).select("path").collect()]
    compacted = _read(spark, f"{tables.root}/silver_compact", chosen)
    return compacted.unionByName(_read(spark, tables.silver, _streamed(spark, tables, manifest))).where(rows)


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest entries of the files in a folder, from one pass over their two key columns."""
    rows = spark.read.schema(silver_schema(spark)).parquet(folder).select(
        "campaign_id", "timestamp", "event_date", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return rows.groupBy("path", "event_date").agg(
        F.first("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("campaign_id").alias("low_campaign"),
        F.max("campaign_id").alias("high_campaign"), F.max(F.col("campaign_id").isNull()).alias("any_null"),
        F.min("timestamp").alias("low_time"), F.max("timestamp").alias("high_time")).withColumn("kind", F.lit("file"))


def _publish(spark: SparkSession, tables: Tables, entries: DataFrame, version: int) -> None:
    """Let a manifest appear by renaming its folder. Another one of this number means that two compactions ran: this one fails."""
    draft, final = f"{tables.root}/silver_drafts/{uuid.uuid4().hex}", f"{_manifests(tables)}/version={version}"
    entries.select(*[c.split()[0] for c in _ENTRY.split(", ")]).coalesce(1).write.parquet(draft)
    files = _files(spark, tables.root)
    files.mkdirs(_path(spark, _manifests(tables)))
    if files.exists(_path(spark, final)) or not files.rename(_path(spark, draft), _path(spark, final)):
        raise RuntimeError(f"manifest {version} exists already: another compaction has run")


def compact(spark: SparkSession, tables: Tables, *, file_bytes: int = FILE_BYTES, small_files: int = SMALL_FILES) -> int | None:
    """Rewrite the days to which more than ``small_files`` files were added since they were rewritten; returns the new version.

    A day's files, old and new, become files of about ``file_bytes``, in ranges of campaign and time, so that their number is
    bounded by the day's size. Nothing is rewritten (None) if no day has so many. A compaction that fails leaves files that no
    manifest names.
    """
    before = _latest(spark, tables)
    manifest = _manifest(spark, tables, before).cache()
    new = _streamed(spark, tables, manifest)
    if not new:
        return None
    added = spark.createDataFrame([(p, p.split("event_date=")[1].split("/")[0]) for p in new], "path string, day string").select(
        "path", F.to_date("day").alias("event_date"))
    busy = [r.event_date for r in added.groupBy("event_date").count().where(F.col("count") > small_files).select("event_date").collect()]
    if not busy:
        return None
    taken = added.where(F.col("event_date").isin(busy))
    old = manifest.where((F.col("kind") == "file") & F.col("event_date").isin(busy))
    rows = _read(spark, tables.silver, [r.path for r in taken.collect()]).unionByName(
        _read(spark, f"{tables.root}/silver_compact", [r.path for r in old.collect()]))
    files, total = _files(spark, tables.root), 0
    for r in taken.select("path").unionByName(old.select("path")).collect():
        total += files.getFileStatus(_path(spark, r.path)).getLen()
    version = 0 if before is None else before + 1
    folder = f"{tables.root}/silver_compact/version={version}-{uuid.uuid4().hex[:8]}"
    order = ["event_date", "campaign_id", "timestamp"]
    (rows.repartitionByRange(max(len(busy), -(-total // file_bytes)), *order).sortWithinPartitions(*order)
     .write.partitionBy("event_date").parquet(folder))
    kept = manifest.where(~((F.col("kind") == "file") & F.col("event_date").isin(busy)))
    covered = taken.select(F.lit("covered").alias("kind"), "path", "event_date")
    entries = kept.unionByName(_measured(spark, folder)).unionByName(covered, allowMissingColumns=True)
    _publish(spark, tables, entries, version)
    manifest.unpersist()
    return version


def expire(spark: SparkSession, tables: Tables, keep: int = 2) -> int:
    """Delete what only manifests older than the ``keep`` newest need: their own files, and stream files that all kept ones cover.

    Readers of those versions must have ended, and every stream that reads silver must be past the files (they are read in
    order of arrival). From then on silver is read by ``read_snapshot`` only. Returns the number of files deleted.
    """
    known = versions(spark, tables)
    gone, stay = known[:-keep], known[-keep:]
    if not gone:
        return 0

    def paths(kind: str, version: int) -> set[str]:
        return {r.path for r in _manifest(spark, tables, version).where(F.col("kind") == kind).select("path").collect()}

    live = set().union(*[paths("file", v) for v in stay])
    covered = set.intersection(*[paths("covered", v) for v in stay])
    files, deleted = _files(spark, tables.root), 0
    for path in sorted(set().union(*[paths("file", v) for v in gone]) - live) + sorted(covered):
        deleted += files.delete(_path(spark, path), False)
    for version in gone:
        files.delete(_path(spark, f"{_manifests(tables)}/version={version}"), True)
    return deleted
