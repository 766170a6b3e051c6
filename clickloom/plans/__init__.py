"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from clickloom.plans import aggregates, attribution, monitoring, ranking, silver

    merged: dict[str, Query] = {}
    for module in (silver, aggregates, ranking, monitoring, attribution):
        merged.update(module.QUERIES)
    return merged


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temporary views for use from SQL: raw deliveries, enriched events and metric points."""
    from clickloom.operators.dedup import dedup
    from clickloom.operators.enrich import enrich
    from clickloom.sources.adapter import ad_events, metric_points

    raw = ad_events(spark, sf_dir)
    raw.createOrReplaceTempView("raw_ad_events")
    dedup(enrich(raw, extra=("ingest_seq",))).drop("ingest_seq").createOrReplaceTempView("ad_events")
    metric_points(spark, sf_dir).createOrReplaceTempView("metric_points")
