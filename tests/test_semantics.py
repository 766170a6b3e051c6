"""Hand-computed cases for the unusual rules."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clickloom.functions import money, ratios
from clickloom.functions.identity import event_key, partition_key, sort_key
from clickloom.operators import alerts, attribution, campaigns, dedup, events, funnel, layout, monitoring, parsing
from clickloom.operators.enrich import enrich
from clickloom.schema import DAY_MS, HOUR_MS, RAW_EVENT


def raw(spark, *rows):
    """Raw events from dicts; absent fields are null."""
    names = [f.name for f in RAW_EVENT.fields]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], RAW_EVENT)


def event(kind="impression", at=0, **more):
    return {"event_type": kind, "timestamp": at, **more}


@pytest.mark.parametrize("revenue, value, kind, expected", [
    (10.0, 10.0, "conversion", (20, 10, 10, 10, 10)),
    (0.0, 7.0, "conversion", (7, 7, 0, 0, 0)),
    (2.5, None, "click", (2.5, 2.5, 0, 2.5, 2.5)),
    (None, None, "impression", (0, 0, 0, 0, 0)),
])
def test_revenue_definitions(spark, revenue, value, kind, expected):
    row = raw(spark, event(kind, revenue_usd=revenue, conversion_value_usd=value))
    got = row.select(*[money.revenue(m).alias(m) for m in money.REVENUE_MODES]).first()
    assert tuple(float(v) for v in got) == expected


def test_ratio_definitions(spark):
    pairs = spark.createDataFrame([(5, 0), (1, 32), (0, 7)], "num int, den int")
    num, den = F.col("num"), F.col("den")
    rows = pairs.select(
        ratios.guarded_percent(num, den), ratios.fraction(num, den),
        ratios.percent_or_zero(num, den), ratios.percent_or_null(num, den)).collect()
    assert tuple(rows[0]) == (500.0, 0.0, 0.0, None)
    assert tuple(rows[1]) == (3.13, 0.03125, 3.13, 3.125)
    assert tuple(rows[2]) == (0.0, 0.0, 0.0, 0.0)


def test_fallback_id(spark):
    rows = raw(
        spark, event("click", 123, event_id="own", user_id="u"), event("click", 123, event_id="", user_id="u", campaign_id="c"),
        event("click", 123, user_id="u"))
    keys = [r[0] for r in rows.select(event_key()).collect()]
    assert keys[0] == "own"
    assert keys[1] == hashlib.md5(b"123|u|c|click").hexdigest()[:16]
    assert keys[2] == hashlib.md5(b"123|u||click").hexdigest()[:16]


def test_storage_keys(spark):
    row = raw(spark, event(at=1704067200123, campaign_id="c1", event_id="e1"), event(at=1704067200123))
    assert [tuple(r) for r in row.select(partition_key(), sort_key()).collect()] == [
        ("c1#2024-01-01", "0001704067200123#e1"), ("unknown#2024-01-01", "0001704067200123#unknown")]


def test_enrichment_defaults_and_time_parts(spark):
    sunday = 1704585600000 + 23 * HOUR_MS  # 2024-01-07
    row = enrich(raw(spark, {"timestamp": sunday, "event_id": "e"})).first()
    assert row.event_type == "unknown" and row.hour_of_day == 23 and row.day_of_week == 6
    assert (row.bid_price_usd, row.revenue_usd, row.conversion_value_usd) == (0, 0, 0)
    assert row.processing_timestamp > sunday
    assert len(row) == 23


def test_line_classes(spark):
    lines = ['{"event_id":"a","timestamp":5}', "", "  \t", "{}", '{ }', '{"event_id":"b"', "not json", '{"event_id":"c","timestamp":null}']
    parsed = parsing.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [r.line_class for r in parsed.collect()] == [
        "event", "blank", "blank", "empty", "empty", "malformed", "malformed", "event"]
    assert [r.event_id for r in parsing.usable(parsed).collect()] == ["a"]
    assert sorted(r.reason for r in parsing.quarantined(parsed).collect()) == ["malformed", "malformed", "no_timestamp"]


def test_ttl_dedup_chains_through_kept_rows(spark):
    days = [0, 6, 8, 16, 16]
    rows = spark.createDataFrame([("x", d * DAY_MS, "p") for d in days] + [("y", 3 * DAY_MS, "p")],
                                 "event_id string, timestamp bigint, payload string")
    kept = {(r.event_id, r.timestamp // DAY_MS) for r in dedup.dedup_ttl(rows).collect()}
    assert kept == {("x", 0), ("x", 8), ("x", 16), ("y", 3)}


def test_ttl_dedup_matches_brute_force_with_a_hot_id(spark):
    import random
    rng = random.Random(3)
    rows = [("hot", rng.randrange(60 * DAY_MS)) for _ in range(1500)]
    rows += [(f"id{rng.randrange(300)}", rng.randrange(60 * DAY_MS)) for _ in range(1500)]
    expected, last = set(), {}
    for key, at in sorted(set(rows), key=lambda r: r[1]):
        if key not in last or at - last[key] > 7 * DAY_MS:
            last[key] = at
            expected.add((key, at))
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "event_id string, timestamp bigint, one int")
    assert {(r.event_id, r.timestamp) for r in dedup.dedup_ttl(df).collect()} == expected


def test_ttl_dedup_stores_no_rows_of_keys_with_few(spark, monkeypatch):
    stored = []

    def counted(df):
        stored.append(df.count())
        return df
    monkeypatch.setattr(dedup, "cut_lineage", counted)
    days, schema = (0, 6, 6, 8, 16), "event_id string, timestamp bigint, payload string"
    many = [(f"id{k}", d * DAY_MS, p) for k in range(50) for d in days for p in ("b", "a", None)]
    gone = [(None, 0, "p"), ("none", None, "p")]
    rows = {tuple(r) for r in dedup.dedup_ttl(spark.createDataFrame(many + gone, schema)).collect()}
    assert rows == {(f"id{k}", d * DAY_MS, None) for k in range(50) for d in (0, 8, 16)}
    assert sum(stored) == 0
    monkeypatch.undo()
    listed = {tuple(r) for r in dedup.dedup_ttl(spark.createDataFrame(many + gone, schema), listed_rows=3).collect()}
    assert listed == rows


def test_dedup_keeps_first_arrival_and_is_idempotent(spark):
    rows = spark.createDataFrame(
        [("a", 5, 1, "late"), ("a", 5, 0, "first"), ("b", 9, 0, "only"), ("a", 7, 0, "later")],
        "event_id string, timestamp bigint, ingest_seq int, tag string")
    once = dedup.dedup(rows)
    assert sorted((r.event_id, r.tag) for r in once.collect()) == [("a", "first"), ("b", "only")]
    assert sorted(dedup.dedup(once).collect()) == sorted(once.collect())


@pytest.mark.parametrize("most_ids", [0, 100])
def test_selective_dedup_equals_dedup_then_filter(spark, most_ids):
    """Copies that disagree: id a first arrives for u1, b first for u2; a lookup must not resurrect later copies."""
    rows = spark.createDataFrame(
        [("a", 1, 0, "u1"), ("a", 2, 0, "u2"), ("b", 1, 0, "u2"), ("b", 3, 0, "u1"), ("c", 5, 0, "u1"), ("c", 5, 1, "u1")],
        "event_id string, timestamp bigint, ingest_seq int, user_id string")
    for user in ("u1", "u2", "u3"):
        condition = F.col("user_id") == user
        got = dedup.dedup_matching(rows, condition, columns=("timestamp", "user_id"), most_ids=most_ids)
        expected = dedup.dedup(rows, columns=("timestamp", "user_id")).where(condition)
        assert sorted(got.collect()) == sorted(expected.collect())


def test_upsert_keeps_last_write(spark):
    rows = spark.createDataFrame([("k", "s", 0, "old"), ("k", "s", 1, "new")], "pk string, sk string, seq int, v string")
    assert [r.v for r in dedup.latest_by_key(rows, ["pk", "sk"], ["seq"]).collect()] == ["new"]


def test_peak_hour_prefers_the_lowest_hour_on_ties(spark):
    rows = raw(spark, event("click", 5 * HOUR_MS), event("impression", 3 * HOUR_MS), event("unknown", 4 * HOUR_MS), event("unknown", 4 * HOUR_MS))
    now = F.lit(6 * HOUR_MS).cast("bigint")
    assert campaigns.peak_hour(rows, now).first().peak_hour == 3
    assert campaigns.peak_hour(rows, F.lit(900 * HOUR_MS).cast("bigint")).first().peak_hour == 0
    assert campaigns.peak_hour(rows.limit(0), F.lit(None).cast("bigint")).first().peak_hour is None


def test_unknown_types_count_toward_totals_only(spark):
    rows = raw(spark, event("unknown", campaign_id="c", revenue_usd=4.0), event("click", campaign_id="c"))
    row = campaigns.performance_by(rows, "campaign_id", with_revenue=True).first()
    assert (row.impressions, row.clicks, row.revenue, row.ctr) == (0, 1, 4.0, 100.0)
    assert campaigns.realtime_totals(rows, F.lit(0).cast("bigint")).first().total_events == 2


def test_null_device_is_a_group(spark):
    rows = raw(spark, event(device_type=None), event(device_type="tv"))
    assert {r.device_type for r in campaigns.performance_by(rows, "device_type").collect()} == {None, "tv"}


def test_active_campaigns_need_impressions(spark):
    rows = raw(spark, event("click", campaign_id="a", revenue_usd=9.0), event(campaign_id="b"), event(campaign_id="b"),
               event("click", campaign_id="b", revenue_usd=1.0))
    top = campaigns.top_campaigns_active(campaigns.campaign_hourly(rows)).collect()
    assert [(r.campaign_id, r.ctr, r.cvr, r.revenue) for r in top] == [("b", 50.0, 0.0, 1.0)]


def test_journey_without_campaigns(spark):
    rows = raw(spark, event(at=9, user_id="u"), event("click", 4, user_id="u", campaign_id="c2"),
               event("click", 5, user_id="u", campaign_id="c1"), event(at=1))
    row = campaigns.user_journey(rows).collect()
    assert len(row) == 1
    assert (row[0].total_events, row[0].first_seen, row[0].last_seen, row[0].campaigns_visited) == (3, 4, 9, "c1,c2")


def test_first_arrivals_stops_at_the_limit(spark):
    rows = spark.range(500).select((F.col("id") * 1000).alias("timestamp"), F.format_string("e%05d", "id").alias("event_id"))
    got = [r.timestamp for r in events.first_arrivals(rows, 130).collect()]
    assert got == [i * 1000 for i in range(130)]
    assert events.first_arrivals(rows, 1000).count() == 500


def test_lookup_limits_are_checked(spark):
    rows = raw(spark, event())
    with pytest.raises(ValueError):
        events.newest(rows, 0)
    with pytest.raises(ValueError):
        events.user_events(rows, "u", 201)
    with pytest.raises(ValueError):
        campaigns.hourly_trends(rows, F.lit(0), 169)
    with pytest.raises(ValueError):
        campaigns.top_performers(rows, F.lit(0), "bids")
    with pytest.raises(ValueError):
        money.revenue("other")


def points(spark, *rows):
    return spark.createDataFrame(
        [(n, i, t, float(v)) for i, (n, t, v) in enumerate(rows)], "name string, point_id bigint, timestamp bigint, value double")


def test_threshold_comparisons(spark):
    rules = alerts.rules_table(spark, [
        ("over", "m", 50.0, "gt", "warning", True), ("under", "m", 50.0, "lt", "critical", True),
        ("equal", "m", 50.0, "eq", "info", True), ("off", "m", 0.0, "gt", "info", False)])
    got = {}
    for r in alerts.evaluate(points(spark, ("m", 1, 50.0), ("m", 2, 50.0005), ("m", 3, 50.001)), rules).collect():
        got.setdefault(r.alert_name, {})[r.timestamp] = r.state
    assert got["over"] == {1: "OK", 2: "ALARM", 3: "ALARM"}
    assert got["under"] == {1: "OK", 2: "OK", 3: "OK"}
    assert got["equal"][1] == got["equal"][2] == "ALARM"
    assert "off" not in got


def test_alarm_changes_and_bookkeeping(spark):
    values = [40, 60, 70, 30, 80]
    pts = points(spark, *[("ProcessingLatency", t, v) for t, v in enumerate(values)])
    rules = alerts.rules_table(spark)
    judged = alerts.evaluate(pts, rules)
    changes = alerts.state_changes(judged).orderBy("timestamp").collect()
    assert [(c.timestamp, c.old_state, c.new_state, c.notify) for c in changes] == [
        (0, "INSUFFICIENT_DATA", "OK", False), (1, "OK", "ALARM", True), (3, "ALARM", "OK", False), (4, "OK", "ALARM", True)]
    assert changes[1].reason == "Metric ProcessingLatency = 60.00 gt 50.0"
    states = {r.alert_name: r for r in alerts.alarm_states(judged, rules).collect()}
    assert (states["HighLatency"].trigger_count, states["HighLatency"].last_triggered) == (3, 4)
    assert states["LowThroughput"].state == "INSUFFICIENT_DATA"
    health = alerts.overall_health(alerts.alarm_states(judged, rules)).first()
    assert (health.overall_status, health.active_alerts) == ("WARNING", 1)


def test_sustained_alarm_needs_adjoining_periods(spark):
    period = 300_000
    pts = points(spark, *[("ProcessingLatency", p * period, 90) for p in (0, 1, 3, 5, 6, 7)])
    got = [(r.period, r.breaching_periods) for r in alerts.sustained_alarms(pts).orderBy("period").collect()]
    assert got == [(1, 2), (6, 2), (7, 3)]


def test_single_statistic(spark):
    pts = points(spark, ("m", 1, 2), ("m", 2, 4), ("m", 9, 100))
    def stat(kind, name="m"):
        return monitoring.metric_statistic(pts, name, F.lit(1), F.lit(2), kind).first().statistic
    assert (stat("AVERAGE"), stat("sum"), stat("Maximum"), stat("minimum"), stat("Count")) == (3, 6, 4, 2, 2)
    assert stat("median") is None and stat("average", "other") is None and stat("count", "other") is None


def test_consumer_status_without_data(spark, sf_dir):
    empty = monitoring.batch_summaries(raw(spark, event()).limit(0))
    row = monitoring.consumer_status(empty).first()
    assert (row.consumer_status, row.events_per_second) == ("no_data", 0.0)


def test_last_touch_gaps_and_ties(spark):
    def row(eid, kind, at):
        return event(kind, at, event_id=eid, user_id="u", session_id="s", campaign_id="c", ad_id="a")
    rows = raw(
        spark, row("i1", "impression", 0), row("i2", "impression", 500), row("i3", "impression", 500), row("k1", "click", 1500),
        row("k2", "click", 1400), row("k3", "click", 300_500), row("k4", "click", 300_501),
        event("click", 1500, event_id="k5", user_id=None, session_id="s", campaign_id="c", ad_id="a"))
    got = {r.click_id: r.impression_id for r in attribution.attribute_clicks(rows).collect()}
    assert got == {"k1": "i3", "k2": "i1", "k3": "i3", "k4": None, "k5": None}


def test_shares_add_up(spark):
    rows = raw(spark, *[event(k) for k in ["impression"] * 3 + ["click"]])
    assert {r.event_type: r.share for r in funnel.share_of_total(rows, "event_type").collect()} == {"impression": 0.75, "click": 0.25}


def test_retention_report(spark):
    rows = raw(spark, event(at=0), event(at=29 * DAY_MS), event(at=31 * DAY_MS))
    report = {r.policy: r.live_rows for r in layout.retention_report(rows, F.lit(31 * DAY_MS)).collect()}
    assert report == {"events": 2, "dedup_ids": 2, "minute_metrics": 1, "campaign_counters": 2, "realtime_cache": 1}


def test_numbers_of_another_type_are_no_errors(spark):
    lines = [
        '{"event_id":"a","timestamp":1704067200000.0}', '{"event_id":"b","timestamp":"1704067200000","click_position_x":12.5}',
        '{"event_id":"c","timestamp":1704067200000,"revenue_usd":"1.5","bid_price_usd":"none","win_price_usd":"NaN","country":7}',
        '{"event_id":"d","timestamp":1704067200000,"click_position_y":true,"city":{"x":1}}', '{"event_id":"e","timestamp":1e99}', '[1', '7']
    parsed = parsing.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = {r.event_id: r for r in parsed.collect()}
    assert [r.line_class for r in parsed.collect()] == ["event"] * 5 + ["malformed"] * 2
    assert all(rows[k].timestamp == 1704067200000 for k in "abcd") and rows["e"].timestamp is None
    assert rows["b"].click_position_x == 12 and rows["d"].click_position_y is None and rows["d"].city == '{"x":1}'
    assert (rows["c"].revenue_usd, rows["c"].bid_price_usd, rows["c"].win_price_usd, rows["c"].country) == (1.5, None, None, "7")
    assert sorted(r.reason for r in parsing.quarantined(parsed).collect()) == ["malformed", "malformed", "no_timestamp"]
