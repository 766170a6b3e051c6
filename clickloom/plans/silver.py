"""Parsing, identity, enrichment, deduplication and storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from clickloom.functions.clock import as_of, event_date
from clickloom.functions.money import revenue
from clickloom.operators import campaigns, dedup as dd, enrich as en, layout, parsing
from clickloom.plans.common import events, now, received, registrar
from clickloom.schema import DAY_MS, ENRICHED_COLUMNS, MONEY_COLUMNS, REDUCED_COLUMNS
from clickloom.sources.adapter import ad_events, ad_events_with_replays, table

QUERIES: dict = {}
query = registrar(QUERIES)


def _money_as_double(df):
    return df.withColumns({c: F.col(c).cast("double") for c in MONEY_COLUMNS if c in df.columns})


@query
def parse_quality(spark, sf_dir):
    """Lines built from every event; some are cut short, blank or empty, as a broken producer would send them."""
    src = F.col("event_id")
    line = F.concat(F.lit('{"event_id":"evt_'), src.cast("string"), F.lit('","event_type":"'), F.col("event_type"),
                    F.lit('","revenue_usd":'), F.col("value").cast("decimal(18,2)").cast("string"), F.lit("}"))
    sent = (
        F.when(src % 41 == 0, F.lit("   ")).when(src % 43 == 0, F.lit("{}"))
        .when(src % 47 == 0, F.expr("left({0}, length({0}) - 4)".format("_line"))).otherwise(F.col("_line"))
    )
    lines = table(spark, sf_dir, "events").select(line.alias("_line"), "event_id").select(sent.alias("value"))
    return parsing.line_quality(lines)


@query
def event_identity(spark, sf_dir):
    raw = ad_events(spark, sf_dir)
    return en.identified(raw).select("src_id", "ingest_seq", "event_id")


@query
def enriched_events(spark, sf_dir):
    columns = tuple(c for c in ENRICHED_COLUMNS if c != "processing_timestamp")
    enriched = en.enrich(ad_events(spark, sf_dir), columns, extra=("ingest_seq",))
    return _money_as_double(dd.dedup(enriched, columns=columns))


@query
def enriched_events_min(spark, sf_dir):
    columns = tuple(c for c in REDUCED_COLUMNS if c != "processing_timestamp")
    enriched = en.enrich(ad_events(spark, sf_dir), columns, extra=("ingest_seq",))
    return _money_as_double(dd.dedup(enriched, columns=columns))


@query
def dedup_events(spark, sf_dir):
    return dd.dedup(received(spark, sf_dir), columns=("event_type", "timestamp", "user_id", "campaign_id"))


@query
def dedup_ttl(spark, sf_dir):
    """Events replayed after 6, 8 and 16 days; an id counts again once 7 days have passed since it last counted."""
    replayed = ad_events_with_replays(spark, sf_dir).where(F.col("event_id").isNotNull())
    return dd.dedup_ttl(replayed.select("event_id", "timestamp", "event_type", "campaign_id"))


@query
def seen_check(spark, sf_dir):
    """Ids of the replayed stream's last ten days, against the ids seen before."""
    replayed = ad_events_with_replays(spark, sf_dir).where(F.col("event_id").isNotNull())
    cut = as_of(replayed) - 10 * DAY_MS
    return dd.seen_check(replayed.where(F.col("timestamp") >= cut), replayed.where(F.col("timestamp") < cut))


@query
def dedup_stats(spark, sf_dir):
    return dd.dedup_stats(received(spark, sf_dir), now(spark, sf_dir))


@query
def keyed_events(spark, sf_dir):
    raw = ad_events(spark, sf_dir).select("event_id", "event_type", "timestamp", "campaign_id", "user_id", "ingest_seq")
    return layout.upserted(raw, now(spark, sf_dir))


@query
def retention_live_events(spark, sf_dir):
    replayed = ad_events_with_replays(spark, sf_dir)
    kept = layout.live(replayed, as_of(replayed))
    return kept.select("src_id", "ingest_seq", event_date().alias("event_date"), "timestamp")


@query
def retention_policies(spark, sf_dir):
    raw = ad_events(spark, sf_dir)
    return layout.retention_report(raw, as_of(raw))


@query
def revenue_definitions(spark, sf_dir):
    return campaigns.revenue_definitions(
        events(spark, sf_dir, "event_type", "revenue_usd", "conversion_value_usd"))


@query
def combined_sources(spark, sf_dir):
    """Feeds with different columns, united by name."""
    raw = ad_events(spark, sf_dir)
    own_columns = {"impression": ["viewability_score"], "click": ["revenue_usd", "engagement_duration_ms"],
                   "conversion": ["revenue_usd", "conversion_value_usd"], "unknown": []}
    feeds = [
        raw.where(F.col("event_type") == kind).select(
            F.lit(kind).alias("feed"), "src_id", "ingest_seq", "timestamp", *extra)
        for kind, extra in own_columns.items()
    ]
    return _money_as_double(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds))


@query
def ingest_summary(spark, sf_dir):
    return dd.arrivals_by_day(ad_events_with_replays(spark, sf_dir), revenue("first_nonzero"))


@query
def source_stats(spark, sf_dir):
    return ad_events(spark, sf_dir).groupBy(F.lit("file").alias("source_type"), "event_type").agg(
        F.count(F.lit(1)).alias("events_written"), F.max("timestamp").alias("last_write_time"))
