"""Duplicate removal, global and with a time to live.

All forms aggregate instead of ranking, so copies are folded before the shuffle and a heavily
repeated id sends at most one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.schema import DAY_MS, DEDUP_TTL_MS
from clickloom.session import BROADCAST_ROWS, broadcast_if_small, cut_lineage


def dedup(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("timestamp", "ingest_seq"),
          columns: tuple[str, ...] | None = None) -> DataFrame:
    """Keep the first arrival of every key. Name the ``columns`` needed, so that no others are shuffled."""
    wanted = [c for c in (columns or events.columns) if c != key]
    ordering = [c for c in order if c in events.columns]
    payload = ordering + [c for c in wanted if c not in ordering]
    first = events.groupBy(key).agg(F.min(F.struct(*payload)).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in wanted])


def dedup_few_copies(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ("timestamp", "ingest_seq"),
                     most_ids: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``dedup``, for tables in which few ids have copies: only those ids' rows are sorted and shuffled.

    Ids with copies are counted first, from the id column alone and by hash. Rows of all other ids pass through as they are read,
    by a broadcast anti join while the list of ids is short; a longer list is joined by a shuffle, and then ``dedup``, which
    folds copies before its shuffle, is the better choice. A null id is an id like any other, as in ``dedup``.
    """
    counts = events.groupBy(F.col(key).alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    copied = broadcast_if_small(counts.where("_n > 1").select("_id"), most_ids)
    same = F.col(key).eqNullSafe(F.col("_id"))
    alone = events.join(copied, same, "left_anti")
    return alone.unionByName(dedup(events.join(copied, same, "left_semi"), key, order).select(*events.columns))


def dedup_matching(events: DataFrame, condition: Column, key: str = "event_id", columns: tuple[str, ...] | None = None,
                   most_ids: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``dedup`` that meet a selective condition, without shuffling the whole table.

    Whether a matching row is the first arrival depends on all copies of its id, matching or not. So the ids with a
    match are found first; if they are few, only their copies are deduplicated, found by a broadcast semi join.
    """
    ids = broadcast_if_small(events.where(condition).select(key).distinct(), most_ids, otherwise=None)
    relevant = events if ids is None else events.join(ids, key, "left_semi")
    return dedup(relevant, key, columns=columns).where(condition)


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the last written row of every key (an upsert table's content)."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    last = rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in order + rest])


#: Rows of a key, copies included, up to which ``dedup_ttl`` lists them.
LISTED_ROWS = 1_000


def dedup_ttl(events: DataFrame, key: str = "event_id", ttl_ms: int = DEDUP_TTL_MS, salts: int = 16,
              listed_rows: int = LISTED_ROWS) -> DataFrame:
    """Keep a row when its key was last *kept* more than ``ttl_ms`` before, as a set-if-absent with expiry does.

    A key with at most ``listed_rows`` rows is one sorted list, walked once: one shuffle of the rows, however often the key
    outlives the TTL. Keys are counted first, so that no longer list is ever built; the hot ones go in rounds.
    Rows without a key or a timestamp are dropped.
    """
    payload = [c for c in events.columns if c not in (key, "timestamp")]
    sent = events.where(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
    hot = cut_lineage(sent.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > listed_rows).select("_key"))
    if hot.isEmpty():
        return _ttl_by_list(sent, key, ttl_ms, payload)
    hot, same = broadcast_if_small(hot), F.col(key) == F.col("_key")
    few = _ttl_by_list(sent.join(hot, same, "left_anti"), key, ttl_ms, payload)
    return few.unionByName(_ttl_in_rounds(sent.join(hot, same, "left_semi"), key, ttl_ms, salts, payload))


def _ttl_by_list(events: DataFrame, key: str, ttl_ms: int, payload: list[str]) -> DataFrame:
    """``dedup_ttl`` for keys with few rows. Of rows with one timestamp, the smallest comes first in the list."""
    row = F.struct("timestamp", F.struct(*payload).alias("_row"))
    lists = events.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    first = F.slice("_rows", 1, 1)
    kept = F.aggregate("_rows", first, lambda done, row: F.when(
        row["timestamp"] - F.element_at(done, -1)["timestamp"] > ttl_ms, F.concat(done, F.array(row))).otherwise(done))
    return lists.select(key, F.inline(kept)).select(key, "timestamp", *[F.col(f"_row.{c}").alias(c) for c in payload])


def _ttl_in_rounds(events: DataFrame, key: str, ttl_ms: int, salts: int, payload: list[str]) -> DataFrame:
    """``dedup_ttl`` for hot keys: each round finds every key's next kept instant as a minimum over its later rows.

    The rounds are few (time span / TTL), and a key is spread over ``salts`` tasks.
    """
    copies = events.groupBy(key, "timestamp").agg(F.min(F.struct(*payload)).alias("_row"))
    unique = cut_lineage(copies)
    frontier = unique.groupBy(key).agg(F.min("timestamp").alias("kept"), F.max("timestamp").alias("_end"))
    kept = frontier.select(key, F.col("kept").alias("timestamp"))
    salt = F.pmod(F.xxhash64("timestamp"), F.lit(salts)).cast("int").alias("_salt")
    instants = unique.select(key, "timestamp", salt)
    all_salts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    while True:
        open_keys = frontier.where(F.col("_end") - F.col("kept") > ttl_ms).select(key, "kept", "_end", all_salts)
        later = cut_lineage(
            instants.join(open_keys, [key, "_salt"])
            .where(F.col("timestamp") - F.col("kept") > ttl_ms)
            .select(key, "timestamp", "_salt", "_end")
        )
        if later.isEmpty():
            break
        frontier = later.groupBy(key).agg(F.min("timestamp").alias("kept"), F.first("_end").alias("_end"))
        instants = later.select(key, "timestamp", "_salt")
        kept = kept.unionByName(frontier.select(key, F.col("kept").alias("timestamp")))
    winners = unique.join(kept, [key, "timestamp"], "left_semi")
    return winners.select(key, "timestamp", *[F.col(f"_row.{c}").alias(c) for c in payload])


def seen_check(batch: DataFrame, seen: DataFrame, key: str = "event_id") -> DataFrame:
    """For every distinct id of the batch: is it in the seen table? Both sides hold an id once."""
    known = seen.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        batch.where(F.col(key).isNotNull()).select(key).distinct()
        .join(known, key, "left")
        .select(key, F.coalesce("_known", F.lit(False)).alias("already_seen"))
    )


def drop_seen(batch: DataFrame, seen: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows of the batch that are new, one per id."""
    return dedup(batch, key).join(seen.select(key).distinct(), key, "left_anti")


def dedup_stats(events: DataFrame, now_ms, ttl_ms: int = DEDUP_TTL_MS, key: str = "event_id") -> DataFrame:
    """Ids tracked within the TTL, and both duplicate rates."""
    per_id = events.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), F.min("timestamp").alias("_first"))
    counts = per_id.agg(
        F.count(F.lit(1)).alias("processed"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("deduped"),
        F.count_if(F.col("_first") >= now_ms - ttl_ms).alias("tracked_ids"),
    )
    processed, deduped = F.col("processed"), F.col("deduped").cast("double")
    return counts.select(
        "tracked_ids", F.lit(ttl_ms * 24 // DAY_MS).cast("int").alias("ttl_hours"),
        "processed", "deduped",
        (deduped / F.greatest(processed, F.lit(1)).cast("double")).alias("rate_of_processed"),
        (deduped / F.greatest(processed + F.col("deduped"), F.lit(1)).cast("double")).alias("rate_of_received"),
    )


def arrivals_by_day(events: DataFrame, revenue, key: str = "event_id") -> DataFrame:
    """Per UTC day of arrival: rows received, new ids, duplicates and the new ids' revenue.

    A row without an id counts as a duplicate. An id is new on the day it is first seen, once.
    """
    day = F.to_date(F.timestamp_millis("timestamp"))
    tagged = events.select(key, "timestamp", "ingest_seq", day.alias("batch_date"), revenue.alias("_revenue"))
    received = tagged.groupBy("batch_date").agg(F.count(F.lit(1)).alias("_rows"))
    new = (
        dedup(tagged.where(F.col(key).isNotNull()), key, columns=("batch_date", "_revenue"))
        .groupBy("batch_date")
        .agg(F.count(F.lit(1)).alias("_new"), F.sum("_revenue").alias("_revenue"))
    )
    joined = received.join(new, "batch_date", "left")
    fresh = F.coalesce("_new", F.lit(0))
    return joined.select(
        "batch_date",
        F.col("_rows").alias("batch_size"),
        fresh.alias("processed"),
        (F.col("_rows") - fresh).alias("duplicates"),
        F.lit(0).cast("bigint").alias("errors"),
        F.coalesce("_revenue", F.lit(0)).cast("double").alias("total_revenue"),
    )
