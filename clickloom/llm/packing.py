"""Best-fit-decreasing packing of token pieces into sequences, with a segment tree over remaining capacities.

Lengths are whole numbers up to the capacity, so pieces of equal length are alike and open sequences with equal room are
alike. A histogram of lengths (at most ``capacity`` rows, whatever the corpus) therefore decides the whole best-fit-decreasing
packing: a segment tree over remaining capacities finds the tightest open kind of sequence for a length in logarithmic time,
and takes as many pieces of that length at once as the kind holds. The resulting plan is a list of runs, ``pieces a..b of length L
go to sequences s.. at offset o``; its size depends on the capacity alone. Pieces then look up their run by length and by
their number among equals, which are counted with salts, so a length that a third of all pieces share is split as well.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.llm.common import partitions, ship_code, table, unit_hash, written
from clickloom.llm.tokens import default_path, tokens

CAPACITY = 1024

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Counts of open sequences by remaining capacity; finds the smallest capacity that is at least a length."""

    def __init__(self, capacity: int):
        self.width = 1 << max(1, capacity.bit_length())
        self.open = [0] * (2 * self.width)

    def add(self, room: int, count: int) -> None:
        node = self.width + room
        while node:
            self.open[node] += count
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest room >= length of an open sequence."""
        node = self.width + length
        if self.open[node]:
            return length
        while node > 1 and (node & 1 or not self.open[node + 1]):  # climb to a right neighbour that has some
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.width:
            node = 2 * node + (not self.open[2 * node])
        return node - self.width


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit-decreasing runs: (length, first piece, pieces, first sequence, pieces per sequence, offset).

    Piece ``first + k`` of the length goes to sequence ``first sequence + k // per`` at ``offset + (k % per) * length``.
    """
    tree, kinds = CapacityTree(capacity), {}  # room -> ranges (first sequence, how many)
    runs, sequences = [], 0

    def shelve(room: int, first: int, count: int) -> None:
        if room:
            kinds.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(histogram, reverse=True):
        placed, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, sequences, -(-left // (capacity // length))
                sequences += count
            else:
                first, count = kinds[room].pop()
                tree.add(room, -count)
            per = room // length
            full = min(count, left // per)
            if full:
                runs.append((length, placed, full * per, first, per, capacity - room))
                shelve(room - per * length, first, full)
                placed, left, first, count = placed + full * per, left - full * per, first + full, count - full
            if left and count:  # the last sequence of this kind gets fewer
                runs.append((length, placed, left, first, left, capacity - room))
                shelve(room - left * length, first, 1)
                placed, left, first, count = placed + left, 0, first + 1, count - 1
            if count:
                shelve(room, first, count)
    return runs


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece. A longer document's first piece takes what is left over; the others are full."""
    ship_code(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens(tokenizer)
        for batch in batches:
            for first, last, ids, bounds in coder.encode(batch.column(1)):
                counts = np.diff(bounds)
                pieces = -(-counts // capacity)
                row = np.repeat(np.arange(last - first), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = counts - (pieces - 1) * capacity
                start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
                length = np.where(number == 0, head[row], capacity)
                raw = memoryview(ids.astype("<u4").view(np.uint8))
                at = 4 * (bounds[:-1][row] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                keys = batch.column(0).slice(first, last - first).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Null and empty texts are one piece of one id (the end id); documents that repeat are packed each; a null doc_id is kept;
    an empty table gives no rows; other columns are ignored. Equal rows may swap places between runs, not more.
    """
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer or default_path(), capacity), "pieces")
    salt = F.pmod(unit_hash("doc_id", "piece", "start", "ids_crc32"), F.lit(4 * partitions(spark))).cast("int")
    salted = pieces.withColumn("salt", salt)
    counts = written(salted.groupBy("length", "salt").count(), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # <= capacity rows
    runs = plan_runs(histogram, capacity)
    plan = runs_table(spark, runs)

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    among = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = salted.withColumn("within", F.row_number().over(among) - 1).join(base, ["length", "salt"]).withColumn(
        "nth", F.col("before") + F.col("within"))
    run = F.element_at("runs", F.aggregate(
        "runs", F.lit(0), lambda n, r: n + (r["first"] <= F.col("nth")).cast("int")))
    found = numbered.join(F.broadcast(plan), "length").withColumn("run", run)
    k = F.col("nth") - F.col("run.first")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("run.sequence") + F.floor(k / F.col("run.per"))).cast("long").alias("sequence_id"),
        (F.col("run.offset") + k % F.col("run.per") * F.col("length")).cast("long").alias("offset"))


def runs_table(spark: SparkSession, runs: list[tuple]) -> DataFrame:
    """The plan by length: at most ``capacity`` rows, each with its runs in order (a few, bounded by the capacity)."""
    by_length: dict[int, list[tuple]] = {}
    for length, first, _, sequence, per, offset in runs:
        by_length.setdefault(length, []).append((first, sequence, per, offset))
    return spark.createDataFrame(
        list(by_length.items()), "length long, runs array<struct<first: long, sequence: long, per: long, offset: long>>")


def op7_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
