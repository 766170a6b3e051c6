"""Streamed distinct users and percentiles against the batch forms."""

import pytest
from pyspark.sql import functions as F

from clickloom.functions.clock import event_date
from clickloom.operators.campaigns import distinct_users
from clickloom.operators.dedup import dedup
from clickloom.plans.common import received
from clickloom.schema import HOUR_MS
from clickloom.sources.adapter import metric_points
from clickloom.streaming import mergeable
from clickloom.streaming.ingest import Tables
from test_streaming import NOW


def counted(df, *keys):
    return sorted((tuple(r[k] for k in keys), r.unique_users) for r in df.collect())


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """Silver in four files, streamed one file a batch, so that users recur over batches."""
    import os

    tables = Tables(str(tmp_path_factory.mktemp("users")))
    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    events = dedup(received(spark, sf_dir)).withColumn("event_date", event_date()).cache()
    for k in range(4):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k).coalesce(1).write.mode("append").partitionBy("event_date").parquet(tables.silver)
        query = mergeable.start_users(spark, tables, trigger=NOW)
        query.awaitTermination(120)
        assert query.exception() is None
    return tables, events


@pytest.mark.parametrize("grain", ["hour", "day", "month", None])
def test_users_equal_the_batch_form_at_every_grain(spark, streamed, grain):
    tables, events = streamed
    path = f"{tables.root}/users"
    keys = ["campaign_id"]
    if grain:
        events = events.withColumn("bucket", F.date_format(F.timestamp_millis("timestamp"), mergeable.GRAINS[grain]))
        keys = ["bucket", "campaign_id"]
    wanted = [r for r in counted(distinct_users(events, *keys), *keys) if r[1]]
    assert counted(mergeable.unique_users(spark, path, grain), *keys) == wanted and wanted


def test_users_of_a_span_after_compaction_and_a_repeated_batch(spark, streamed):
    tables, events = streamed
    path, checkpoint = f"{tables.root}/users", tables.checkpoint("users")
    first = events.agg(F.min("timestamp")).first()[0] // HOUR_MS * HOUR_MS
    last = first + 36 * HOUR_MS - 1
    wanted = events.where(F.col("timestamp").between(first, last)).agg(F.count_distinct(F.nullif("user_id", F.lit("")))).first()[0]

    def span():
        return mergeable.unique_users(spark, path, None, by_campaign=False, first_ms=first, last_ms=last).first().unique_users
    assert span() == wanted
    assert mergeable.compact(spark, path, checkpoint, mergeable.merge_users, "hour") == 3 and span() == wanted
    again = spark.read.parquet(f"{path}/partial/batch=3").cache()
    again.count()
    mergeable.add_batch(again, path, 4, "hour")  # users that are known already
    assert span() == wanted


def test_percentiles_of_a_span_without_the_points(spark, tmp_path, sf_dir):
    points = metric_points(spark, sf_dir).select("name", "timestamp", F.col("value").cast("double").alias("value")).cache()
    source, path, checkpoint = (str(tmp_path / n) for n in ("points", "sketches", "checkpoint"))
    for k in range(3):
        points.where(F.pmod(F.xxhash64("timestamp", "value"), F.lit(3)) == k).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(points.schema).parquet(source)
        query = mergeable.start_percentiles(stream, path, checkpoint, trigger=NOW)
        query.awaitTermination(120)
        assert query.exception() is None
    middle = points.agg(F.expr("percentile_approx(timestamp, 0.5)")).first()[0] // mergeable.MINUTE_MS * mergeable.MINUTE_MS
    for step in range(2):
        for first, last in ((None, None), (middle, None), (None, middle - 1)):
            inside = points.where(F.col("timestamp").between(first or 0, last or 1 << 60))
            values = {r.name: sorted(r.v) for r in inside.groupBy("name").agg(F.collect_list("value").alias("v")).collect()}
            got = {r.name: r for r in mergeable.percentiles(spark, path, first_ms=first, last_ms=last).collect()}
            assert set(got) == set(values)
            for name, v in values.items():
                assert got[name].samples == len(v) and abs(got[name].mean - sum(v) / len(v)) < 1e-6 * max(1, abs(got[name].mean))
                for p, rank in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
                    low, high = sum(x < got[name][p] for x in v) / len(v), sum(x <= got[name][p] for x in v) / len(v)
                    assert low - 0.006 <= rank <= high + 0.006
        if step == 0:
            assert mergeable.compact(spark, path, checkpoint, mergeable.merge_sketches, "minute") == 2
