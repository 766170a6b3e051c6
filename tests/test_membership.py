"""Bitmaps of seen ids: exact answers, few ids compared; batches by their day of arrival."""

from pyspark.sql import functions as F

from clickloom.operators import membership
from clickloom.schema import DAY_MS, RAW_EVENT
from clickloom.streaming.ingest import ingest_batch

START = 1704067200000
REST = [(f.name, f.dataType.simpleString()) for f in RAW_EVENT.fields if f.name not in ("event_id", "timestamp", "event_type")]
DAY = "date'2024-01-01'"


def made(spark, first, last, day=DAY):
    return spark.range(first, last).selectExpr("concat('id-', id) AS event_id", f"{day} AS arrival_date")


def test_new_ids_are_exact_and_few_are_compared(spark):
    seen = made(spark, 0, 20_000).unionByName(made(spark, 20_000, 70_000, "date'2024-01-02'"))
    bitmaps = membership.build_bitmaps(seen)
    assert {r.bits for r in bitmaps.collect()} == {1 << 19, 1 << 20}
    batch = made(spark, 69_000, 100_000).select("event_id")
    batch = batch.unionByName(batch.limit(5)).unionByName(spark.createDataFrame([(None,)], "event_id string"))
    maybe = membership.maybe_seen(batch, bitmaps)
    assert 1000 <= maybe.count() < 1000 + 2 * 30_000 / membership.BITS * 1.2
    got = membership.new_ids(batch, seen, bitmaps)
    assert got.count() == 30_000 and got.agg(F.min(F.substring("event_id", 4, 9).cast("int"))).first()[0] == 70_000
    assert membership.new_ids(batch, seen.limit(0), membership.build_bitmaps(seen.limit(0))).count() == 31_000


def test_merged_bitmaps_are_those_of_all_ids(spark):
    one, two = made(spark, 0, 3000), made(spark, 2000, 5000)
    bits = 1 << 17
    merged = membership.merge_bitmaps(membership.build_bitmaps(one, bits=bits).unionByName(membership.build_bitmaps(two, bits=bits)))
    whole = membership.build_bitmaps(one.unionByName(two), bits=bits)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_ids_are_known_by_arrival_not_by_event_time(spark, tmp_path):
    path = str(tmp_path / "silver")

    def events(*pairs):
        return spark.createDataFrame([(i, START + at) for i, at in pairs], "event_id string, timestamp long").selectExpr(
            "*", "'click' AS event_type", *[f"CAST(NULL AS {t}) AS {c}" for c, t in REST])

    first = ingest_batch(events(("old", -30 * DAY_MS), ("a", 0)), path, 0, START).first()
    assert first.processed == 2
    # a re-delivery of an event from weeks ago, whose first copy came yesterday
    assert ingest_batch(events(("old", -30 * DAY_MS), ("b", 0), ("b", 1)), path, 1, START + DAY_MS).first().processed == 1
    assert ingest_batch(events(("old", -30 * DAY_MS), ("b", 0)), path, 1, START + 3 * DAY_MS).first().processed == 1  # a retry
    assert ingest_batch(events(("a", 0), ("b", 0), ("c", 0)), path, 2, START + 8 * DAY_MS).first().processed == 2  # a is forgotten
    days = {(r.batch, str(r.arrival_date)) for r in spark.read.parquet(path).collect()}
    assert days == {(0, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-09")}
