"""Progress of queries as metric points that rules judge."""

import time

from pyspark.sql import functions as F

from clickloom.operators import alerts
from clickloom.streaming.ingest import Tables
from clickloom.streaming.progress import ProgressMetrics
from test_streaming import event, put, run


def test_progress_becomes_points_that_rules_judge(spark, tmp_path):
    folder, tables, metrics = str(tmp_path / "in"), Tables(str(tmp_path / "out")), str(tmp_path / "metrics")
    listener = ProgressMetrics(spark, metrics, flush_seconds=3600)
    spark.streams.addListener(listener)
    try:
        put(folder, "ad_events-1.jsonl", [event(f"e{k}", at=k) for k in range(20)])
        run(spark, folder, tables)
        until = time.time() + 20
        while time.time() < until and not any(p[0] == "EventsReceived" and p[5]["query"] == "silver" and p[2] == 20.0 for p in listener.kept):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    listener.close()
    points = spark.read.parquet(metrics)
    received = {r["q"]: r["n"] for r in points.where("name = 'EventsReceived'").groupBy(F.col("dimensions")["query"].alias("q")).agg(
        F.sum("value").alias("n")).collect()}
    assert received["bronze"] == received["silver"] == 20.0
    assert points.where("name = 'StateRows' AND dimensions['query'] = 'silver'").agg(F.max("value")).first()[0] == 20.0
    rules = spark.createDataFrame([("Slow", "ProcessingLatency", 0.0, "gt", "warning", True)], alerts.rules_table(spark).schema)
    judged = alerts.evaluate(points, alerts.rules_table(spark, rules))
    assert {r.state for r in judged.select("state").distinct().collect()} == {"ALARM"}
