"""What the optimizer makes of the queries."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import campaigns, events as ev, layout
from clickloom.operators.dedup import dedup
from clickloom.plans import all_queries
from clickloom.plans.common import received
from clickloom.sources.silver import SILVER_SETTING

QUERIES = all_queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


@pytest.fixture(scope="module")
def silver(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "table")
    layout.write_silver(dedup(received(spark, sf_dir)), path, 2)
    spark.conf.set(SILVER_SETTING, path)
    yield path
    spark.conf.unset(SILVER_SETTING)


def test_silver_gives_the_same_answers(spark, sf_dir, silver):
    import compare
    from oracle import all_sql
    connection = compare.duck(sf_dir)
    for name in ("top_campaigns", "hourly_trends", "campaign_metrics_today", "campaign_day_events", "user_journey",
                 "top_performers_ctr", "dashboard_today", "campaign_performance_range", "data_quality", "latest_events",
                 "user_events", "user_recent_events", "campaign_recent_events", "minute_history"):
        assert compare.difference(QUERIES[name](spark, sf_dir), connection, all_sql()[name]) is None, name


def test_lookups_prune_dates_and_push_filters(spark, sf_dir, silver):
    text = plan(QUERIES["campaign_day_events"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(event_date" in text and "2024-01-15" in text
    assert "EqualTo(campaign_id,campaign_7)" in text
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_only_needed_columns_are_read(spark, sf_dir, silver):
    text = plan(QUERIES["device_performance"](spark, sf_dir))
    assert "ReadSchema: struct<event_type:string,device_type:string>" in text


def test_a_literal_now_prunes_at_planning_time(spark, sf_dir, silver):
    table = spark.read.parquet(silver)
    text = plan(campaigns.hourly_trends(table, F.lit(1706659032194), 24))
    assert "PartitionFilters" in text and "2024-01-29" in text
    assert "GreaterThanOrEqual(timestamp" in text


def test_a_computed_now_still_filters_partitions(spark, sf_dir, silver):
    text = plan(QUERIES["campaign_metrics_today"](spark, sf_dir))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert any("Subquery" in line or "subquery" in line for line in filters)


def test_dedup_folds_copies_before_the_shuffle(spark, sf_dir):
    text = plan(dedup(received(spark, sf_dir), columns=("campaign_id",)))
    assert "partial_min" in text and text.count("Exchange") == 2  # once in the tree, once in the details


def test_per_key_samples_prune_before_the_shuffle(spark, sf_dir):
    text = plan(ev.newest_per_key(spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")), "user_id"))
    assert text.count("WindowGroupLimit") >= 2
