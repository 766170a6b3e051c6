"""Relations that must hold between results, whatever the data."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom.operators import campaigns
from clickloom.operators.dedup import dedup
from clickloom.plans.common import events
from clickloom.schema import DAY_MS

_EVENTS = st.lists(
    st.tuples(st.integers(0, 9), st.integers(0, 3 * DAY_MS), st.sampled_from(["impression", "click", "conversion", "unknown"]),
              st.sampled_from(["a", "b", None]), st.integers(0, 500)),
    min_size=1, max_size=40)


def frame(spark, rows):
    return spark.createDataFrame(
        [(f"e{i}", t, k, c, f"u{i % 3}", v / 100, None) for i, t, k, c, v in rows],
        "event_id string, timestamp bigint, event_type string, campaign_id string, user_id string, revenue_usd double, conversion_value_usd double")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_EVENTS, seed=st.randoms())
def test_order_of_arrival_in_the_file_does_not_matter(spark, rows, seed):
    shuffled = list(rows)
    seed.shuffle(shuffled)
    once, other = dedup(frame(spark, rows)), dedup(frame(spark, shuffled))
    assert sorted(map(str, once.collect())) == sorted(map(str, other.collect()))
    assert once.count() == len({r[0] for r in rows})


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_EVENTS)
def test_campaigns_and_devices_add_up(spark, rows):
    df = frame(spark, rows)
    whole = campaigns.processing_totals(df).first()
    parts = campaigns.performance_by(df, "campaign_id", with_revenue=True).agg(
        F.sum("clicks"), F.sum("impressions"), F.sum(F.col("revenue").cast("decimal(20,2)"))).first()
    assert (parts[0], parts[1]) == (whole.clicks_processed, whole.impressions_processed)
    assert abs(float(parts[2]) - whole.revenue_processed_usd) < 1e-6


def test_hours_add_up_to_days_and_months(spark, sf_dir):
    buckets = campaigns.campaign_metrics_bucketed(
        events(spark, sf_dir, "timestamp", "user_id", "campaign_id", "event_type", "revenue_usd", "conversion_value_usd"))
    day = F.when(F.col("time_period") == "month", F.col("time_bucket")).otherwise(F.substring("time_bucket", 1, 7))
    sums = buckets.groupBy("time_period", "campaign_id", day.alias("m")).agg(
        F.sum("clicks").alias("c"), F.sum(F.col("revenue_usd").cast("decimal(20,4)")).alias("r"))
    spread = sums.groupBy("campaign_id", "m").agg(F.count_distinct("c").alias("c"), F.count_distinct("r").alias("r"), F.count("*").alias("n"))
    assert spread.where("c <> 1 or r <> 1 or n <> 3").count() == 0
