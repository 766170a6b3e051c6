"""Deduplication that sorts and shuffles only ids with copies."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators.dedup import dedup, dedup_few_copies
from clickloom.plans.common import received


def made(spark, rows, share):
    """``rows`` ids, of which ``share`` percent come twice, one of them very often, and some without an id."""
    base = spark.range(rows).selectExpr("concat('e', id) AS event_id", "id * 7 % 1000 AS timestamp", "id AS ingest_seq", "id % 13 AS payload")
    again = base.where(F.col("ingest_seq") % 100 < share).withColumn("ingest_seq", F.col("ingest_seq") + rows)
    hot = spark.range(50).selectExpr("'e1' AS event_id", "1000 + id AS timestamp", "id AS ingest_seq", "99L AS payload")
    return base.unionByName(again).unionByName(hot).unionByName(hot.withColumn("event_id", F.lit(None).cast("string")))


@pytest.mark.parametrize("share, most", [(0, 1000), (2, 1000), (50, 1000), (50, 10)])
def test_rows_are_those_of_dedup(spark, share, most):
    events = made(spark, 2000, share)
    got = sorted(map(tuple, dedup_few_copies(events, most_ids=most).select(*events.columns).collect()), key=repr)
    assert got == sorted(map(tuple, dedup(events).select(*events.columns).collect()), key=repr)


def test_rows_of_the_table(spark, sf_dir):
    events = received(spark, sf_dir)
    columns = [c for c in events.columns if c != "ingest_seq"]
    digest = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    assert dedup_few_copies(events).agg(digest, F.count("*")).first() == dedup(events).agg(digest, F.count("*")).first()


def test_single_rows_are_neither_sorted_nor_shuffled(spark, tmp_path):
    path = str(tmp_path / "events")
    made(spark, 2000, 2).write.parquet(path)
    plan = dedup_few_copies(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Union")[1].split("LeftSemi")[0].split("SortAggregate")[0]
    assert "BroadcastHashJoin" in single and "LeftAnti" in single
    assert "Sort " not in single and "Exchange hashpartitioning" not in single
