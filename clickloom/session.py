"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "clickloom", master: str | None = None, **overrides: str) -> SparkSession:
    """Create a session. ``overrides`` use ``__`` for dots, e.g. ``spark__ui__enabled="false"``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; fall back to a scratch folder in local mode only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="clickloom-checkpoint-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that later steps all read the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_slices(spark: SparkSession) -> int:
    """How many ordered slices to cut: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_ROWS = 100_000


_SAME = object()


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, otherwise=_SAME) -> DataFrame | None:
    """Broadcast a side after counting it (no further than the bound); a larger one is left to a shuffled join.

    For aggregates that are expected to be tiny but depend on the data. They are checkpointed, so the count is no
    second computation, and the join that follows does not shuffle its big side by a handful of keys.
    ``otherwise`` is returned in place of a side that is too large.
    """
    stored = cut_lineage(df)
    if stored.limit(rows + 1).count() <= rows:
        return F.broadcast(stored)
    return stored if otherwise is _SAME else otherwise
