"""Inputs shared by the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from clickloom.functions.clock import as_of
from clickloom.operators.dedup import dedup, dedup_matching
from clickloom.operators.enrich import identified
from clickloom.sources.adapter import ad_events
from clickloom.sources.silver import silver_table


def registrar(registry: dict) -> Callable:
    def register(query):
        registry[query.__name__] = query
        return query
    return register


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries, each with an id."""
    return identified(ad_events(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Duplicate-free events with just the named columns; only those are read and shuffled.

    A session that names a silver table reads that; otherwise duplicates are removed on the way.
    """
    table = silver_table(spark)
    if table is not None:
        return table.select("event_id", *columns, "event_date")
    return dedup(received(spark, sf_dir), columns=columns)


def events_matching(spark: SparkSession, sf_dir: str, condition: Column, *columns: str) -> DataFrame:
    """Duplicate-free events that meet a selective condition on the named columns."""
    table = silver_table(spark)
    if table is not None:
        return events(spark, sf_dir, *columns).where(condition)
    return dedup_matching(received(spark, sf_dir), condition, columns=columns)


def now(spark: SparkSession, sf_dir: str) -> Column:
    """The newest event time, from a scan of one column."""
    table = silver_table(spark)
    return as_of(ad_events(spark, sf_dir) if table is None else table)
