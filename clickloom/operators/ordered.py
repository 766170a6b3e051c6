"""Order-dependent operators that no single key can overload.

A window partitioned by a hot key puts all its rows into one task. Here rows are range-partitioned on
(keys, order) into slices, so one key may span many slices; each slice is processed on its own, and
what a slice needs from earlier ones travels in a table with at most two rows per slice.
The order columns must identify a row within its key, otherwise ties could not be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.session import broadcast_if_small, cut_lineage, shuffle_slices

SLICE = "_slice"


@dataclass(frozen=True)
class Sliced:
    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    @property
    def within(self):
        return Window.partitionBy(*self.keys, SLICE).orderBy(*self.order)

    @property
    def position(self) -> Column:
        return F.struct(*self.order)

    def edge_summaries(self, *summaries: Column) -> DataFrame:
        """Aggregate the keys at either edge of a slice: the only ones that can reach another slice."""
        key = F.struct(*self.keys)
        edges = self.rows.groupBy(SLICE).agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
        return (
            self.rows.join(F.broadcast(edges), SLICE)  # one row per slice
            .where((key == F.col("_low")) | (key == F.col("_high")))
            .groupBy(SLICE, *self.keys)
            .agg(*summaries)
        )

    def with_carry(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(carry), [SLICE, *self.keys], "left")  # two rows per slice at most

    @property
    def earlier(self):
        return (Window.partitionBy(*self.keys).orderBy(SLICE)
                .rowsBetween(Window.unboundedPreceding, -1))


def slice_rows(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> Sliced:
    """Cut ``df`` into ordered slices of about equal size.

    The slices are written to the checkpoint folder: rows and edge summaries must see the same cuts.
    """
    count = slices or shuffle_slices(df.sparkSession)
    ranged = df.repartitionByRange(count, *keys, *order).withColumn(SLICE, F.spark_partition_id())
    return Sliced(cut_lineage(ranged), tuple(keys), tuple(order))


def with_previous(sliced: Sliced, value: str, name: str) -> DataFrame:
    """Add the value of the preceding row of the same key; null on the first."""
    ends = sliced.edge_summaries(F.max_by(F.col(value), sliced.position).alias("_end"))
    carry = ends.select(SLICE, *sliced.keys, F.last("_end").over(sliced.earlier).alias("_carry"))
    rows = sliced.rows.select(
        "*",
        F.lag(value).over(sliced.within).alias("_lag"),
        F.row_number().over(sliced.within).alias("_nth"),
    )
    return (
        sliced.with_carry(rows, carry)
        .withColumn(name, F.when(F.col("_nth") == 1, F.col("_carry")).otherwise(F.col("_lag")))
        .drop("_lag", "_nth", "_carry", SLICE)
    )


def with_last_known(sliced: Sliced, value: str, name: str) -> DataFrame:
    """Add the newest non-null value of the same key up to and including this row."""
    known = F.when(F.col(value).isNotNull(), sliced.position)
    ends = sliced.edge_summaries(F.max_by(F.col(value), known).alias("_end"))
    carry = ends.select(SLICE, *sliced.keys, F.last("_end", True).over(sliced.earlier).alias("_carry"))
    so_far = sliced.within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sliced.rows.withColumn("_known", F.last(value, True).over(so_far))
    return (
        sliced.with_carry(rows, carry)
        .withColumn(name, F.coalesce("_known", "_carry"))
        .drop("_known", "_carry", SLICE)
    )


def with_running_totals(sliced: Sliced, **totals: str) -> DataFrame:
    """Add running sums (``new_name="column"``) and the 1-based position ``nth`` within the key."""
    ends = sliced.edge_summaries(
        F.count(F.lit(1)).alias("_n"), *[F.sum(col).alias(f"_sum_{name}") for name, col in totals.items()]
    )
    carry = ends.select(
        SLICE, *sliced.keys,
        F.sum("_n").over(sliced.earlier).alias("_carry_n"),
        *[F.sum(f"_sum_{name}").over(sliced.earlier).alias(f"_carry_{name}") for name in totals],
    )
    so_far = sliced.within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sliced.rows.select(
        "*",
        F.row_number().over(sliced.within).alias("_nth"),
        *[F.sum(col).over(so_far).alias(f"_run_{name}") for name, col in totals.items()],
    )
    joined = sliced.with_carry(rows, carry)
    columns = [c for c in sliced.rows.columns if c != SLICE]
    return joined.select(
        *columns,
        (F.col("_nth") + F.coalesce("_carry_n", F.lit(0))).alias("nth"),
        *[(F.col(f"_run_{name}") + F.coalesce(f"_carry_{name}", F.lit(0))).alias(name) for name in totals],
    )


def exact_percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, int]) -> DataFrame:
    """Nearest-rank percentiles per key. ``points`` maps output names to whole percents.

    Rows are first folded to a histogram, whose running totals are then split over slices.
    """
    histogram = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    sliced = slice_rows(histogram, keys, [value])
    sizes = broadcast_if_small(sliced.rows.groupBy(*keys).agg(F.sum("_n").alias("_size")))
    ranked = with_running_totals(sliced, _cum="_n").join(sizes, keys)
    return ranked.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_cum") * 100 >= F.col("_size") * percent, F.col(value))).alias(name)
        for name, percent in points.items()
    ])
