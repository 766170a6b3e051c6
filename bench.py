"""Times the headline queries and the ingest path; prints one JSON line.

Every query runs from the raw table (duplicates removed on the way). The same lookups and reports then run on a silver
table, as a deployment would; those keys start with ``silver_``. ``ingest`` goes from JSON lines, ten for every row of
the table with ids of their own, through parsing, enrichment and deduplication to the dated silver layout.
``stream_ingest`` sends the same lines, from 16 files, through the streaming job (bronze, stateful deduplication, silver, side tables), once.
``queries`` holds the second of two runs, ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from clickloom.operators.dedup import dedup  # noqa: E402
from clickloom.operators.enrich import enrich  # noqa: E402
from clickloom.operators.layout import write_silver  # noqa: E402
from clickloom.operators.parsing import parse_lines, usable  # noqa: E402
from clickloom.plans import all_queries  # noqa: E402
from clickloom.schema import RAW_EVENT  # noqa: E402
from clickloom.session import build_session  # noqa: E402
from clickloom.sources.adapter import ad_events  # noqa: E402
from clickloom.sources.silver import SILVER_SETTING  # noqa: E402
from clickloom.streaming.ingest import Tables, start_ingest  # noqa: E402

FROM_RAW = (
    "parse_quality", "enriched_events", "dedup_events", "dedup_ttl", "keyed_events", "processing_totals",
    "campaign_performance", "hourly_trends", "campaign_metrics_bucketed", "user_journey", "dashboard_today",
    "top_campaigns", "latest_events", "user_recent_events", "moving_latency", "rolling_5min", "latency_summary",
    "alert_transitions", "alarm_current", "attribute_clicks", "attribute_conversions_by_user", "session_summary",
    "engagement_summary",
)
FROM_SILVER = (
    "campaign_performance", "hourly_trends", "campaign_metrics_bucketed", "campaign_metrics_today", "user_journey",
    "top_campaigns", "latest_events", "campaign_day_events", "conversion_rates", "session_summary",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "clickloom-bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def run(name: str) -> None:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("top_campaigns")  # start-up cost of the JVM
    cold, warm = {}, {}

    def measure(prefix: str, names) -> None:
        for name in names:
            cold[prefix + name] = timed(lambda: run(name))
            warm[prefix + name] = timed(lambda: run(name))

    measure("", FROM_RAW)

    scratch = tempfile.mkdtemp(prefix="clickloom-bench-")
    raw = ad_events(spark, sf_dir)
    raw.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).select(
        F.to_json(F.struct(F.concat("event_id", F.lit("_"), F.col("copy").cast("string")).alias("event_id"),
                           *[c for c in raw.columns if c in RAW_EVENT.names and c != "event_id"])).alias("value"),
    ).repartition(2 * int(cpus)).write.text(f"{scratch}/bronze")
    lines = spark.read.text(f"{scratch}/bronze")
    rows = lines.count()
    for run_times, folder in ((cold, "first"), (warm, "silver")):
        ingested = dedup(enrich(usable(parse_lines(lines)), extra=("attributed_campaign_id", "attributed_ad_id", "win_price_usd")))
        run_times["ingest"] = timed(lambda: write_silver(ingested, f"{scratch}/{folder}", int(cpus)))

    def stream() -> None:
        for query in start_ingest(spark, {"file_path": f"{scratch}/bronze"}, Tables(f"{scratch}/stream"), trigger={"availableNow": True}):
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()

    warm["stream_ingest"] = timed(stream)

    spark.conf.set(SILVER_SETTING, f"{scratch}/silver")
    measure("silver_", FROM_SILVER)
    spark.conf.unset(SILVER_SETTING)

    print(json.dumps({
        "metric": "total query time", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "ingest_rows": rows,
        "ingest_rows_per_sec": round(rows / warm["ingest"]), "stream_rows_per_sec": round(rows / warm["stream_ingest"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
