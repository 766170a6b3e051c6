"""Sliced operators against plain windows, with one key holding most rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from clickloom.operators import monitoring
from clickloom.operators.ordered import (exact_percentiles, slice_rows, with_last_known, with_previous, with_running_totals)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}"
        rows.append((key, rng.randrange(50_000), i, rng.randrange(1000) if rng.random() < 0.5 else None))
    return spark.createDataFrame(rows, "name string, timestamp bigint, point_id bigint, value bigint").cache()


ORDER = ["timestamp", "point_id"]


def plain():
    return Window.partitionBy("name").orderBy(*ORDER)


def same(left, right):
    return sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.select(*left.columns).collect()), key=str)


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_previous(skewed, slices):
    mine = with_previous(slice_rows(skewed, ["name"], ORDER, slices), "value", "before")
    assert same(mine, skewed.withColumn("before", F.lag("value").over(plain())))


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_last_known(skewed, slices):
    mine = with_last_known(slice_rows(skewed, ["name"], ORDER, slices), "value", "known")
    so_far = plain().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert same(mine, skewed.withColumn("known", F.last("value", True).over(so_far)))


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_running_totals(skewed, slices):
    filled = skewed.withColumn("value", F.coalesce("value", F.lit(1)))
    mine = with_running_totals(slice_rows(filled, ["name"], ORDER, slices), total="value")
    so_far = plain().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = filled.withColumn("nth", F.row_number().over(plain()).cast("bigint")).withColumn("total", F.sum("value").over(so_far))
    assert same(mine, expected)


def test_slices_split_the_hot_key(skewed):
    sliced = slice_rows(skewed, ["name"], ORDER, 16)
    sizes = [r["count"] for r in sliced.rows.groupBy("_slice").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 600
    carried = sliced.edge_summaries(F.count("*").alias("n")).count()
    assert carried <= 2 * len(sizes)


def test_moving_average(skewed):
    pts = skewed.withColumn("value", F.coalesce("value", F.lit(1)).cast("decimal(20,4)"))
    mine = monitoring.moving_average(pts, 50)
    frame = plain().rowsBetween(-49, Window.currentRow)
    expected = pts.withColumn("moving_average", F.sum("value").over(frame).cast("double") / F.count("*").over(frame))
    assert same(mine, expected)


def test_rolling_window_across_slices(skewed):
    pts = skewed.withColumn("value", F.coalesce("value", F.lit(1)).cast("decimal(20,4)")).withColumn("timestamp", F.col("timestamp") * 1000)
    seconds = pts.groupBy("name", F.floor(F.col("timestamp") / 1000).alias("second")).agg(
        F.sum("value").alias("s"), F.count("*").alias("n"), F.max("value").alias("m"))
    trailing = Window.partitionBy("name").orderBy("second").rangeBetween(-300, 0)
    expected = seconds.select(
        "name", "second", (F.sum("s").over(trailing).cast("double") / F.sum("n").over(trailing).cast("double")).alias("mean_5min"),
        F.max("m").over(trailing).cast("double").alias("peak_5min"), F.sum("n").over(trailing).alias("points_5min"))
    for width in (60, 3600):
        assert same(monitoring.rolling_window(pts, 300, width), expected)


def test_percentiles_are_nearest_rank(skewed):
    got = {r.name: (r.p50, r.p95) for r in exact_percentiles(skewed, ["name"], "value", {"p50": 50, "p95": 95}).collect()}
    values: dict = {}
    for r in skewed.where("value is not null").collect():
        values.setdefault(r.name, []).append(r.value)
    for name, vs in values.items():
        vs.sort()
        assert got[name] == tuple(vs[-(-len(vs) * p // 100) - 1] for p in (50, 95))


def test_large_sides_are_not_broadcast(skewed):
    from clickloom.session import broadcast_if_small

    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(skewed.limit(5), 5))
    assert not hinted(broadcast_if_small(skewed.limit(6), 5))
    assert broadcast_if_small(skewed.limit(6), 5, otherwise=None) is None
