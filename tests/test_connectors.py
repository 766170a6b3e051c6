import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators import layout
from clickloom.operators.parsing import parse_lines, well_formed
from clickloom.plans.common import received
from clickloom.operators.dedup import dedup
from clickloom.sources import connectors as co


def test_types_and_environment():
    assert co.source_type({}) == "file"
    assert co.source_type({"type": "KINESIS"}) == "kinesis"
    with pytest.raises(ValueError):
        co.source_type({"type": "ftp"})
    assert co.input_config({})["type"] == "file"
    assert co.input_config({"USE_KINESIS": "True"})["stream_name"] == "ad-events-stream"
    assert co.output_config({"USE_DYNAMODB": "true", "USE_KINESIS_OUTPUT": "true"})["type"] == "dynamodb"
    assert co.output_config({"USE_KINESIS_OUTPUT": "true"})["type"] == "kinesis"
    assert co.output_config({"OUTPUT_FILE_PATH": "/x"}) == {"type": "file", "file_path": "/x"}


def test_json_round_trip(spark, tmp_path, sf_dir):
    path = str(tmp_path / "out")
    events = dedup(received(spark, sf_dir), columns=("event_type", "timestamp", "user_id", "campaign_id"))
    co.append_events(events, path)
    co.append_events(events.limit(0), path)
    back = well_formed(parse_lines(co.read_lines(spark, {"file_path": path})))
    assert back.count() == events.count()
    stats = co.source_metrics(back, {"file_path": path}).first()
    assert (stats.type, stats.location, stats.events_written) == ("file", path, events.count())


def test_stream_records_are_keyed_by_user_then_event(spark):
    rows = spark.createDataFrame([("e1", "u1", 1, "c", "click"), ("e2", None, 2, "c", "click"), ("e3", "", 3, "c", "click")],
                                 "event_id string, user_id string, timestamp bigint, campaign_id string, event_type string")
    got = co.stream_records(rows).collect()
    assert [r.partitionKey for r in got] == ["u1", "e2", "e3"]
    assert json.loads(got[1].data) == {"event_id": "e2", "user_id": None, "timestamp": 2, "campaign_id": "c", "event_type": "click"}


def test_upsert_replaces_rows_of_touched_days_only(spark, tmp_path, sf_dir):
    path = str(tmp_path / "silver")
    events = dedup(received(spark, sf_dir)).select("event_id", "timestamp", "campaign_id", "user_id")
    layout.upsert_keyed(events, path, 0)
    total = spark.read.parquet(path).count()
    assert total == events.count()
    changed = events.where("event_id like 'evt_1%'").withColumn("user_id", F.lit("moved"))
    fresh = changed.unionByName(spark.createDataFrame([("brand_new", 1704067200000, "c", "u")], changed.schema))
    for _ in range(2):
        layout.upsert_keyed(fresh, path, 1)
    after = spark.read.parquet(path)
    assert after.count() == total + 1
    assert after.where("user_id = 'moved'").count() == changed.count()


def test_keyed_sink_through_a_stream(spark, tmp_path, sf_dir):
    path, source = str(tmp_path / "keyed"), str(tmp_path / "in")
    events = dedup(received(spark, sf_dir)).select("event_id", "timestamp", "campaign_id", "user_id")
    layout.upsert_keyed(events.where("event_id < 'evt_5'"), path, -1)
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    q = co.write_stream(stream, {"type": "DynamoDB", "file_path": path}, str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    assert spark.read.parquet(path).count() == events.count()


def test_metrics_table(spark, tmp_path):
    from clickloom.sources.metrics import put_points, read_points

    path = str(tmp_path / "metrics")
    put_points(spark.createDataFrame([("EventsPerSecond", 5.0, 1706659032194)], "name string, value double, timestamp bigint"), path)
    put_points(spark.createDataFrame([("ErrorRate", 1.0, 1706600000000, "percent")],
                                     "name string, value double, timestamp bigint, unit string"), path)
    rows = read_points(spark, path, F.lit(1706659032194 + 1000)).collect()
    assert [(r.name, r.unit, r.metric_type, r.dimensions) for r in rows] == [("EventsPerSecond", "count", "gauge", {})]
    assert spark.read.parquet(path).count() == 2


def test_views_serve_sql(spark, sf_dir):
    from clickloom.plans import register_views

    register_views(spark, sf_dir)
    row = spark.sql("SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM ad_events").first()
    assert row.n == row.ids < spark.table("raw_ad_events").count()
