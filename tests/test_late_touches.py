"""Streamed attribution in any order of arrival equals the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators.attribution import attribute_clicks, attribute_conversions, last_touch
from clickloom.operators.dedup import dedup
from clickloom.plans.common import received
from clickloom.schema import HOUR_MS
from clickloom.streaming.attribution import CLICKS, CONVERSIONS, attribute_batch, read_links

START = 1704067200000
SCHEMA = "event_id string, event_type string, timestamp long, user_id string, session_id string, campaign_id string, ad_id string"


def links(df):
    return {r.event_id: r.touch.id if r.touch else None for r in df.collect()}


def made(seed: int, n: int = 160):
    """Few keys, one of them hot, null keys, equal times, gaps on both sides of the limits."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = START + rng.choice((0, 359_999, 360_000, 168 * HOUR_MS, 168 * HOUR_MS + 1, rng.randrange(9 * 24) * HOUR_MS))
        rows.append((f"e{i:03d}", rng.choice(("click", "conversion", "impression")), at, rng.choice(("u", "u", "u", "v", None)), "s",
                     rng.choice(("c", None)), "a"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_batches_of_made_events(spark, tmp_path, seed):
    rows, path = made(seed), str(tmp_path / "links")
    rng = random.Random(seed)
    rng.shuffle(rows)
    cuts = [rows[:50], rows[50:60], [], rows[60:130], rows[130:]]
    for k, part in enumerate(cuts):
        attribute_batch(spark.createDataFrame(part, SCHEMA), path, k, keys=("user_id", "ad_id"))
    attribute_batch(spark.createDataFrame(cuts[1], SCHEMA), path, 1, keys=("user_id", "ad_id"))  # a repeated batch sees no later rows
    attribute_batch(spark.createDataFrame(cuts[4], SCHEMA), path, 4, keys=("user_id", "ad_id"))
    whole = spark.createDataFrame(rows, SCHEMA)
    wanted = last_touch(whole.where("event_type = 'conversion'"), whole.where("event_type = 'click'"), ("user_id", "ad_id"),
                        CONVERSIONS["gap_ms"])
    assert links(read_links(spark, path)) == links(wanted)
    versions = spark.read.parquet(f"{path}/answers").groupBy("event_id").count()
    assert versions.where("count > 1").count() > 0  # late touches did correct earlier answers


@pytest.mark.parametrize("link, batch_form, target", [(CONVERSIONS, attribute_conversions, "conversion_id"), (CLICKS, attribute_clicks, "click_id")])
def test_arrival_backwards_equals_the_batch_keys(spark, tmp_path, sf_dir, link, batch_form, target):
    path = str(tmp_path / "links")
    events = dedup(received(spark, sf_dir)).select(*[c.split()[0] for c in SCHEMA.split(", ")]).cache()
    first, last = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    third = (last - first) // 3 + 1
    for k in range(3):  # the newest events come first
        batch = events.where(((last - F.col("timestamp")) / third).cast("int") == k)
        attribute_batch(batch, path, k, **link)
    touch = "click_id" if target == "conversion_id" else "impression_id"
    wanted = {r[target]: r[touch] for r in batch_form(events).collect()}
    assert links(read_links(spark, path)) == wanted and any(wanted.values())
