"""Attribution kept up to date from the silver stream, whatever order touches and targets arrive in.

A stream-stream join would emit every pair within the gap, which explodes for a busy key. Instead two narrow tables are kept,
of touches and of targets (what is to be attributed). A micro-batch adds its own rows to both; it then answers its own targets
and, again, those stored targets that its touches reach, by one ordered last-touch pass over the touches of their keys. Answers
are versioned by batch, and the newest counts: a touch that comes after its target corrects the answer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.clock import event_date
from clickloom.operators.attribution import CLICK_GAP_MS, CLICK_KEYS, CONVERSION_GAP_MS, CONVERSION_KEYS, last_touch
from clickloom.session import broadcast_if_small, cut_lineage
from clickloom.streaming.ingest import Tables, _make_folder, silver_schema

#: What is linked to what: the settings of the two kinds of link.
CONVERSIONS = {"later": "conversion", "earlier": "click", "keys": CONVERSION_KEYS, "gap_ms": CONVERSION_GAP_MS}
CLICKS = {"later": "click", "earlier": "impression", "keys": CLICK_KEYS, "gap_ms": CLICK_GAP_MS}

_SCHEMA = ("event_id string, timestamp long, user_id string, session_id string, campaign_id string, ad_id string, batch long, "
           "day date")
_NARROW = ("event_id", "timestamp", "user_id", "session_id", "campaign_id", "ad_id")


def _day(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def _store(rows: DataFrame, path: str, batch_id: int, keys: tuple[str, ...]) -> None:
    """Replace the batch's own rows; files are sorted by keys, so that row groups of other keys are passed over."""
    (rows.select(*_NARROW, event_date().alias("day")).repartition("day", *keys).sortWithinPartitions("day", *keys, "timestamp")
     .write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={batch_id}"))


def _all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def _stored(spark: SparkSession, path: str, first_ms: int, last_ms: int) -> DataFrame:
    """Stored rows of the days between two instants."""
    return _all(spark, path).where(F.col("day").between(_day(F.lit(first_ms)), _day(F.lit(last_ms)))
                      & F.col("timestamp").between(first_ms, last_ms))


def _reached(rows: DataFrame, by: DataFrame, keys: tuple[str, ...], before_ms: int, after_ms: int) -> DataFrame:
    """Rows with the keys of a row of ``by`` and a time between its first time plus ``before_ms`` and its last plus ``after_ms``.

    ``by`` is folded to a row per key first, so that no pairs are made; it is broadcast if that is a small table.
    """
    reach = by.groupBy(*keys).agg((F.min("timestamp") + before_ms).alias("_from"), (F.max("timestamp") + after_ms).alias("_to")).dropna()
    joined = rows.join(broadcast_if_small(reach), list(keys))
    return joined.where(F.col("timestamp").between(F.col("_from"), F.col("_to"))).select(*rows.columns)


def _span(rows: DataFrame) -> tuple[int, int] | None:
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    return None if first is None else (first, last)


def attribute_batch(batch: DataFrame, path: str, batch_id: int, later: str = "conversion", earlier: str = "click",
                    keys: tuple[str, ...] = CONVERSION_KEYS, gap_ms: tuple[int, int] = CONVERSION_GAP_MS) -> None:
    """Store a batch's touches and targets, and answer all targets that it is about. Repeating a batch replaces its own rows.

    Batches run one after another. A batch that is repeated sees no rows of later ones.
    """
    spark = batch.sparkSession
    least, most = gap_ms
    _store(batch.where(F.col("event_type") == earlier), f"{path}/touches", batch_id, keys)
    _store(batch.where(F.col("event_type") == later), f"{path}/targets", batch_id, keys)
    mine = F.col("batch") == batch_id

    def table(name: str, first: int, last: int) -> DataFrame:
        return _stored(spark, f"{path}/{name}", first, last).where(F.col("batch") <= batch_id)

    own_touches = _all(spark, f"{path}/touches").where(mine)
    waiting = _all(spark, f"{path}/targets").where(mine)
    reach = _span(own_touches)
    if reach is not None:
        earlier_targets = table("targets", reach[0] + least, reach[1] + most).where(~mine)
        waiting = waiting.unionByName(_reached(earlier_targets, own_touches, keys, least, most))
    waiting = cut_lineage(waiting)
    span = _span(waiting)
    if span is None:
        return
    touches = _reached(table("touches", span[0] - most, span[1] - least), waiting, keys, -most, -least)
    answers = last_touch(waiting, touches, keys, gap_ms).withColumn("day", event_date())
    answers.write.mode("overwrite").partitionBy("day").parquet(f"{path}/answers/batch={batch_id}")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """The newest answer for every target: event_id, timestamp, its keys, and the touch (null: none in reach)."""
    answers = spark.read.parquet(f"{path}/answers")
    rest = [c for c in answers.columns if c not in ("event_id", "batch", "day")]
    return answers.groupBy("event_id").agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_r")).select("event_id", "_r.*")


def start_attribution(spark: SparkSession, tables: Tables, path: str, trigger: Mapping | None = None, **link) -> StreamingQuery:
    """Keep the links under ``path``. ``link`` is ``CONVERSIONS`` (the default), ``CLICKS`` or other settings."""
    _make_folder(spark, tables.silver)
    schema = silver_schema(spark)
    name = f"attribution_{link.get('later', 'conversion')}"
    return (
        spark.readStream.schema(schema).parquet(tables.silver)
        .writeStream.queryName(name)
        .foreachBatch(lambda batch, batch_id: attribute_batch(batch, path, batch_id, **link))
        .option("checkpointLocation", tables.checkpoint(name))
        .trigger(**dict(trigger or {"processingTime": "10 minutes"})).start()
    )
