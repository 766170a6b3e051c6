"""Streaming jobs: equal to the batch form, restartable, and safe to replay."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from clickloom.functions.clock import event_date
from clickloom.operators import alerts, campaigns
from clickloom.operators.attribution import attribute_conversions
from clickloom.operators.dedup import dedup
from clickloom.operators.enrich import enrich
from clickloom.operators.layout import upsert_keyed
from clickloom.operators.monitoring import record_status
from clickloom.operators.parsing import parse_lines, usable
from clickloom.plans.common import received
from clickloom.schema import DAY_MS, HOUR_MS, RAW_EVENT
from clickloom.sources.adapter import metric_points
from clickloom.sources.connectors import write_stream
from clickloom.sources.metrics import put_points, read_points
from clickloom.streaming.alarms import process_points, start_alarms, summary_points
from clickloom.streaming.attribution import read_links, start_attribution
from clickloom.streaming.gold import (campaign_metrics, compact_gold, minute_windows, read_gold, refresh_gold, sliding_hour,
                                      start_gold, write_campaign_metrics)
from clickloom.streaming.ingest import Tables, ingest_batch, progress_metrics, start_ingest

START = 1704067200000
NOW = {"availableNow": True}


def event(eid, kind="impression", at=0, **more):
    return {"event_id": eid, "event_type": kind, "timestamp": None if at is None else START + at, "user_id": "u1",
            "campaign_id": "c1", "ad_id": "a1", "session_id": "s1", **more}


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


FILES = [
    ("ad_events-01.jsonl", [event("i1"), event("k1", "click", 60_000, revenue_usd=1.5),
                            event("v1", "conversion", 2 * HOUR_MS, revenue_usd=9.0, conversion_value_usd=9.0)]),
    ("ad_events-02.jsonl", [event("i1"), event("k1", "click", 60_000, revenue_usd=1.5), event("i2", at=5_000), event("i2", at=5_000)]),
    ("ad_events-03.jsonl", ["", "{}", '{"event_id":"cut', "not json"]),
    ("ad_events-04.jsonl", [event(None, at=7_000), event("", at=7_000), event(None, at=8_000)]),
    ("ad_events-05.jsonl", [event("poison", at=None), event("future", at=20000 * DAY_MS), event("late", at=-2 * DAY_MS),
                            event("overflow", at=9 * 10**18 - START), event("underflow", at=-9 * 10**18),
                            event("rich", "conversion", revenue_usd=1e30)]),
]


@pytest.fixture
def bronze(tmp_path):
    folder = str(tmp_path / "bronze")
    for name, lines in FILES:
        put(folder, name, lines)
    return folder


def run(spark, folder, tables, **more):
    queries = start_ingest(spark, {"file_path": folder, "pattern": "ad_events*.jsonl", "max_files_per_trigger": 2}, tables,
                           trigger=NOW, **more)
    for q in queries:
        q.awaitTermination(120)
        assert q.exception() is None
    return queries


def ids(spark, tables):
    return sorted(r.event_id for r in spark.read.parquet(tables.silver).collect())


def batch_ids(spark, folder):
    lines = spark.read.text(folder)
    horizon = F.unix_millis(F.current_timestamp()) + 8 * DAY_MS
    return sorted(r.event_id for r in dedup(enrich(usable(parse_lines(lines), horizon))).collect())


@pytest.mark.parametrize("copy_salts", [0, 4])
def test_stream_equals_batch(spark, tmp_path, bronze, copy_salts):
    tables = Tables(str(tmp_path / "out"))
    queries = run(spark, bronze, tables, copy_salts=copy_salts)
    silver = ids(spark, tables)
    assert silver == batch_ids(spark, bronze)
    assert len(silver) == 8 and {"late", "rich"} < set(silver) and "future" not in silver
    reasons = sorted(r.reason for r in spark.read.parquet(tables.quarantine).collect())
    assert reasons == ["before_epoch", "beyond_horizon", "beyond_horizon", "malformed", "malformed", "no_timestamp"]
    summaries = spark.read.parquet(tables.summaries)
    totals = summaries.agg(F.sum("errors"), F.sum(F.col("processed") + F.col("deduped")), F.sum("revenue")).first()
    assert (totals[0], totals[1], float(totals[2])) == (2, 12, 21.0)
    assert sum(p["rows"] for p in progress_metrics(queries[0])) > 0 and len(queries) == 3


def test_restart_continues_without_duplicates(spark, tmp_path):
    folder, tables = str(tmp_path / "bronze"), Tables(str(tmp_path / "out"))
    put(folder, *FILES[0])
    run(spark, folder, tables)
    for name, lines in FILES[1:]:
        put(folder, name, lines)
    run(spark, folder, tables)
    assert ids(spark, tables) == batch_ids(spark, folder)


def test_ids_are_forgotten_a_ttl_after_their_first_sight(spark, tmp_path):
    """The time to live runs from arrival, so an event's own time, however far ahead, neither ends nor extends it."""
    folder, tables = str(tmp_path / "bronze"), Tables(str(tmp_path / "out"))
    for n, lines in enumerate([[event("x")], [event("x", at=6 * DAY_MS)], [event("y")], [event("x", at=7 * DAY_MS)]]):
        if n == 2:
            time.sleep(2)
        put(folder, f"ad_events-{n}.jsonl", lines)
        run(spark, folder, tables, ttl_ms=DAY_MS if n < 2 else 1000)
    days = sorted((r.timestamp - START) // DAY_MS for r in spark.read.parquet(tables.silver).where("event_id = 'x'").collect())
    assert days == [0]


@pytest.mark.parametrize("copy_salts", [0, 3])
def test_no_line_is_lost_behind_future_events(spark, tmp_path, copy_salts):
    """Conversions dated far ahead, between current and older events, over several batches and restarts."""
    folder, tables = str(tmp_path / "bronze"), Tables(str(tmp_path / "out"))
    now = int(time.time() * 1000) - START
    ahead = [1, 167, 191]
    count = 0
    for n in range(4):
        lines = [event(f"now{n}", at=now), event(f"old{n}", at=now - 2 * HOUR_MS), event(f"week{n}", at=now - 9 * DAY_MS), "broken", event(f"far{n}", at=now + 9 * DAY_MS)]
        lines += [event(f"v{n}-{h}", "conversion", now + h * HOUR_MS, revenue_usd=1.0) for h in ahead]
        put(folder, f"ad_events-{n}.jsonl", lines)
        count += len(lines)
        run(spark, folder, tables, copy_salts=copy_salts)
        for q in start_gold(spark, tables, trigger=NOW):
            q.awaitTermination(120)
            assert q.exception() is None
    silver = spark.read.parquet(tables.silver)
    assert sorted(r.event_id for r in silver.collect()) == sorted(
        [f"{k}{n}" for k in ("now", "old", "week") for n in range(4)] + [f"v{n}-{h}" for n in range(4) for h in ahead])
    assert silver.count() + spark.read.parquet(tables.quarantine).count() == count

    def counters(df):
        return sorted((r.window_start, r.events, r.conversions, r.revenue) for r in df.collect())
    exact = counters(minute_windows(silver.withColumn("event_ts", F.timestamp_millis("timestamp"))))
    assert counters(read_gold(spark, tables.minutes)) == exact
    # a torn folder of a batch that was not committed stays out of the compacted sums, and counts once it is written again
    torn, late = f"{tables.minutes}/partial/batch=4", spark.read.parquet(f"{tables.minutes}/partial/batch=0")
    late.limit(1).write.parquet(torn)
    assert compact_gold(spark, tables.minutes, tables.checkpoint("minutes")) == 3
    late.write.mode("overwrite").parquet(torn)
    assert counters(read_gold(spark, tables.minutes)) != exact
    late.limit(0).write.mode("overwrite").parquet(torn)
    assert counters(read_gold(spark, tables.minutes)) == exact
    assert compact_gold(spark, tables.minutes, tables.checkpoint("minutes")) == 3
    hours = read_gold(spark, tables.campaign_hours)
    assert hours.agg(F.sum("events")).first()[0] == silver.count()


def test_records_become_points_alarms_and_status(spark, tmp_path):
    """One chain: lines, processing records, metric points, the metrics table, alarm states, status."""
    folder, tables, metrics, root = str(tmp_path / "bronze"), Tables(str(tmp_path / "out")), str(tmp_path / "metrics"), str(tmp_path / "alarms")
    put(folder, "ad_events-1.jsonl", [event(f"e{k}", ("impression", "click")[k % 2], revenue_usd=2.0, user_id=f"u{k}") for k in range(8)] + [event("e1"), "bad"])
    run(spark, folder, tables)
    records = spark.read.parquet(tables.summaries)
    record = records.first()
    assert (record.processed, record.deduped, record.errors, record.impressions_processed, record.clicks_processed) == (8, 1, 1, 5, 4)
    assert (record.unique_users, record.unique_campaigns, record.lines) == (8, 1, 10) and record.duration > 0
    put_points(summary_points(records), metrics)
    points = read_points(spark, metrics, F.lit(record.last_timestamp))
    process_points(points, root, 0)
    states = {r.alert_name: r.state for r in spark.read.parquet(f"{root}/states").collect()}
    assert states["LowThroughput"] == "ALARM" and states["HighErrorRate"] == "ALARM" and len(states) == 4
    status = record_status(records).first()
    assert (status.consumer_status, status.deduplication_rate, status.unique_users) == ("active", 12.5, 8)
    assert record_status(records.limit(0)).first().consumer_status == "no_metrics"


def test_a_late_point_does_not_turn_an_alarm_back(spark, tmp_path):
    root = str(tmp_path)

    def points(*rows):
        return spark.createDataFrame(list(rows), "name string, point_id bigint, timestamp bigint, value double")
    process_points(points(("ProcessingLatency", 2, 2000, 90.0)), root, 0)
    process_points(points(("ProcessingLatency", 1, 1000, 10.0)), root, 1)
    state = spark.read.parquet(f"{root}/states/batch=1").first()
    assert (state.state, state.timestamp, state.trigger_count) == ("ALARM", 2000, 1)
    assert spark.read.parquet(f"{root}/changes/batch=1").count() == 0


def test_keyed_sink_starts_empty_and_the_last_arrival_wins(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "event_id string, campaign_id string, timestamp bigint, city string"
    for n, city in enumerate(("zz-first", "aa-last", "bb-later")):
        spark.createDataFrame([("e", "c", START, city), (f"only{n}", None, START + n * DAY_MS, city)], schema).coalesce(1).write.mode("append").parquet(source)
    files = sorted((f for f in os.listdir(source) if f.endswith(".parquet")), key=lambda f: os.stat(f"{source}/{f}").st_mtime_ns)
    for n, f in enumerate(files):
        os.utime(f"{source}/{f}", (1_700_000_000 + n * 100,) * 2)
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = write_stream(stream, {"type": "dynamodb", "file_path": path}, str(tmp_path / "checkpoint")).trigger(**NOW).start()
        q.awaitTermination(120)
        assert q.exception() is None
    rows = {r.event_id: r for r in spark.read.parquet(path).collect()}
    assert len(rows) == 4 and rows["e"].city == "bb-later" and rows["only0"].partition_key.startswith("unknown#") and rows["e"].ttl > 0
    upsert_keyed(spark.createDataFrame([("e", "c", START, "replayed")], schema), path, 2)
    assert {r.event_id: r.city for r in spark.read.parquet(path).collect()}["e"] == "replayed"
    one = spark.createDataFrame([("f", "c", START, "zz"), ("f", "c", START, "aa")], schema).coalesce(1)
    upsert_keyed(one, path, 3)
    assert {r.event_id: r.city for r in spark.read.parquet(path).collect()}["f"] == "aa"


def raw(spark, rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in RAW_EVENT.fields) for r in rows], RAW_EVENT)


def test_batch_ingest_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = raw(spark, [event("a", "click", revenue_usd=2.0), event("b"), event("b"), event(None)])
    second = raw(spark, [event("a", "click", revenue_usd=2.0), event("c", "conversion", revenue_usd=0.0, conversion_value_usd=5.0)])
    for _ in range(2):
        row = ingest_batch(first, path, 0).first()
        assert (row.batch_size, row.processed, row.duplicates, row.total_revenue) == (4, 2, 2, 2.0)
    for _ in range(2):
        row = ingest_batch(second, path, 1).first()
        assert (row.processed, row.duplicates, row.total_revenue) == (1, 1, 5.0)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        ingest_batch(first.limit(0), path, 2)


def test_gold_equals_batch(spark, tmp_path, sf_dir):
    tables, exact = Tables(str(tmp_path / "out")), Tables(str(tmp_path / "exact"))
    events = dedup(received(spark, sf_dir)).withColumn("event_date", event_date())
    events.write.partitionBy("event_date").parquet(tables.silver)
    for q in start_gold(spark, tables, trigger=NOW):
        q.awaitTermination(120)
        assert q.exception() is None
    silver = spark.read.parquet(tables.silver).withColumn("event_ts", F.timestamp_millis("timestamp"))
    expected = {r.window_start: (r.events, r.revenue) for r in minute_windows(silver).collect()}
    assert {r.window_start: (r.events, r.revenue) for r in read_gold(spark, tables.minutes).collect()} == expected
    refresh_gold(spark, tables, exact, "2023-12-01", "2024-01-31")
    assert {r.window_start: (r.events, r.revenue) for r in spark.read.parquet(exact.minutes).collect()} == expected
    hours = spark.read.parquet(exact.campaign_hours)
    counters = campaigns.campaign_hourly(events)
    assert hours.count() == counters.count()
    assert hours.agg(F.sum("clicks")).first()[0] == counters.agg(F.sum("clicks")).first()[0]


def test_alarm_stream_equals_batch(spark, tmp_path, sf_dir):
    points = metric_points(spark, sf_dir).select("name", "point_id", "timestamp", F.col("value").cast("double").alias("value"))
    source, root = str(tmp_path / "points"), str(tmp_path / "alarms")
    cuts = [0, 333, 600, 10**9]
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        points.where(F.col("point_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(source)
    files = sorted((f for f in os.listdir(source) if f.endswith(".parquet")), key=lambda f: spark.read.parquet(f"{source}/{f}").agg(F.min("point_id")).first()[0])
    for n, f in enumerate(files):
        os.utime(f"{source}/{f}", (1_700_000_000 + n * 100, 1_700_000_000 + n * 100))
    told = []
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = start_alarms(stream, root, notify=lambda rows: told.append(rows.count()), trigger=NOW)
    q.awaitTermination(120)
    assert q.exception() is None

    def shown(df):
        return sorted(tuple(r) for r in df.select("alert_name", "point_id", "old_state", "new_state", "reason").collect())
    judged = alerts.evaluate(points, alerts.rules_table(spark))
    expected = alerts.state_changes(judged)
    assert shown(spark.read.parquet(f"{root}/changes")) == shown(expected)
    assert sum(told) == expected.where("notify").count()
    last = spark.read.parquet(f"{root}/states/batch={len(files) - 1}").where("trigger_count > 0")
    now = {r.alert_name: (r.state, r.trigger_count) for r in alerts.alarm_states(judged, alerts.rules_table(spark)).collect()}
    assert {r.alert_name: (r.state, r.trigger_count) for r in last.collect()} == {k: now[k] for k, v in now.items() if v[1]}
    before = shown(spark.read.parquet(f"{root}/changes"))
    batch = points.where(F.col("point_id").between(cuts[1], cuts[2] - 1))
    process_points(batch, root, 1)
    assert shown(spark.read.parquet(f"{root}/changes")) == before


def test_attribution_stream_equals_batch(spark, tmp_path, sf_dir):
    tables, path = Tables(str(tmp_path / "out")), str(tmp_path / "links")
    events = dedup(received(spark, sf_dir)).withColumn("event_date", event_date())
    events.write.partitionBy("event_date").parquet(tables.silver)
    q = start_attribution(spark, tables, path, NOW, keys=("user_id",))
    q.awaitTermination(120)
    assert q.exception() is None
    got = {r.event_id: r.touch.id if r.touch else None for r in read_links(spark, path).collect()}
    expected = {r.conversion_id: r.click_id for r in attribute_conversions(events, ("user_id",)).collect()}
    assert got == expected and any(expected.values())


def test_summaries_become_metric_points(spark):
    batches = spark.createDataFrame([(3, 1000, 10, 2.0, 100.0, 77)],
                                    "batch bigint, processed bigint, errors bigint, duration double, revenue double, last_timestamp bigint")
    got = {r.name: r.value for r in summary_points(batches).collect()}
    assert got == {"EventsProcessed": 1000.0, "EventsPerSecond": 500.0, "ProcessingLatency": 2.0, "ErrorRate": 1.0,
                   "TotalRevenue": 100.0, "RevenuePerHour": 180000.0}


def test_campaign_lookup_prefers_the_stored_row(spark, tmp_path, sf_dir):
    gold = str(tmp_path / "metrics")
    silver = dedup(received(spark, sf_dir)).withColumn("event_date", event_date())
    now = silver.agg(F.max("timestamp")).first()[0]
    stored_until = silver.where(F.col("timestamp") < now - now % HOUR_MS)
    write_campaign_metrics(stored_until, gold)
    campaign = silver.where(F.col("timestamp") < now - now % HOUR_MS).orderBy(F.desc("timestamp")).first().campaign_id

    def look(period, at=now):
        return campaign_metrics(spark, gold, silver, campaign, F.lit(at), period).collect()
    month = look("month")
    assert [r.origin for r in month] == ["stored"]
    assert month[0].clicks == stored_until.where((F.col("campaign_id") == campaign) & (F.col("event_type") == "click")).count()
    today = look("hour")
    assert [r.origin for r in today] == ["computed"]
    on_day = silver.where((F.col("campaign_id") == campaign) & (F.col("event_date") == F.to_date(F.timestamp_millis(F.lit(now)))))
    assert today[0].impressions == on_day.where("event_type = 'impression'").count()
    assert look("day", now + 400 * DAY_MS) == []
    with pytest.raises(ValueError):
        look("week")


def test_sliding_hour_on_a_stream(spark, tmp_path, sf_dir):
    source = str(tmp_path / "in")
    dedup(received(spark, sf_dir)).write.parquet(source)
    table = spark.read.parquet(source).withColumn("event_ts", F.timestamp_millis("timestamp"))
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    timed = stream.withColumn("event_ts", F.timestamp_millis("timestamp")).withWatermark("event_ts", "1 hour")
    out = str(tmp_path / "out")
    q = sliding_hour(timed).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    expected = {r.as_of: r.events for r in sliding_hour(table).collect()}
    got = {r.as_of: r.events for r in spark.read.parquet(out).collect()}
    assert len(got) > 1000 and all(expected[k] == v for k, v in got.items())
