"""Which ids were seen in the last days, with bitmaps that rule most of them out before anything is joined.

Every day of arrival has one bitmap of ``BITS`` bits for an id, cut into pieces of 32,768 bits (a row each): the bit at an
id's hash is set. An id whose bit is not set on any day is new for certain; only the others (one new id in ``BITS`` for each day)
go on to an exact anti join. Bitmaps are built by an aggregation that combines before its shuffle, and those of equal size merge
by ``or``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 16
PIECE = 32_768


def _place(key: str, bits: Column) -> Column:
    """The place of an id's bit, from 1: the built-in functions number bits from there."""
    return F.pmod(F.xxhash64(key), bits) + 1


def build_bitmaps(arrivals: DataFrame, key: str = "event_id", day: str = "arrival_date", bits: int | None = None) -> DataFrame:
    """(day, bits, piece, bitmap) for all days of ``arrivals``. Without ``bits`` each day's number of rows decides."""
    rows = arrivals.where(F.col(key).isNotNull()).select(day, key)
    if bits is None:
        size = F.greatest(F.lit(PIECE), F.pow(2.0, F.ceil(F.log2(F.col("_n") * F.lit(float(BITS)))))).cast("long")
        sizes = rows.groupBy(day).agg(F.count("*").alias("_n")).select(day, size.alias("bits"))
        rows = rows.join(F.broadcast(sizes), day)  # one row a day
    else:
        rows = rows.withColumn("bits", F.lit(bits).cast("long"))
    place = _place(key, F.col("bits"))
    return rows.groupBy(day, "bits", F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, day: str = "arrival_date") -> DataFrame:
    """One bitmap for each day and size: for days whose ids came in several batches."""
    return bitmaps.groupBy(day, "bits", "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2.0), position % 8)).cast("int") % 2 == 1


def maybe_seen(batch: DataFrame, bitmaps: DataFrame, key: str = "event_id", day: str = "arrival_date") -> DataFrame:
    """The distinct ids of ``batch`` whose bit is set on some day. All ids that were seen are among them.

    An id meets one piece of each size of bitmap, not all days' pieces one by one: the days of a size are merged first.
    """
    ids = batch.where(F.col(key).isNotNull()).select(key).distinct()
    every = bitmaps.groupBy("bits", "piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    placed = _placed(ids, bitmaps.select("bits").distinct(), key)
    hits = placed.join(every, ["bits", "piece"]).where(_is_set(F.col("bitmap"), F.col("position")))
    return hits.select(key).distinct()


def _placed(ids: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Every id with its piece and bit for each size of bitmap. Sizes are powers of two: there are at most some forty."""
    known = [r.bits for r in sizes.collect()]
    if not known:
        return ids.limit(0).selectExpr(key, "0L AS bits", "0L AS piece", "0L AS position")
    each = ids.withColumn("bits", F.explode(F.array(*[F.lit(b).cast("long") for b in known])))
    place = _place(key, F.col("bits"))
    return each.select(key, "bits", F.bitmap_bucket_number(place).alias("piece"), F.bitmap_bit_position(place).alias("position"))


def new_ids(batch: DataFrame, seen: DataFrame, bitmaps: DataFrame, key: str = "event_id", day: str = "arrival_date") -> DataFrame:
    """The distinct ids of ``batch`` that are not in ``seen``, exactly. Only ids that may have been seen are compared with it."""
    ids = batch.where(F.col(key).isNotNull()).select(key).distinct()
    known = maybe_seen(batch, bitmaps, key, day).join(seen.select(key), key, "left_semi")
    return ids.join(known, key, "left_anti")
