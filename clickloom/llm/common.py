"""Helpers that the training-data operators share: tables, code shipping, durable cuts, folders, salted order."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.session import ensure_checkpoint_dir

#: White space of the word contracts: a word is a run of any other characters.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Give executors this package, for clusters where it is not installed. Once for each session."""
    context = spark.sparkContext
    if getattr(context, "_clickloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="clickloom-code-"), "clickloom_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._clickloom_shipped = True


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for this run in the cluster's shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps see one fixed copy, whatever executors are lost."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``shared_folder`` made, once its rows are no longer needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), "")).cast("long")


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A uniform 62-bit number from the columns' values; the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 2)


def ranked(df: DataFrame, group: list[str], order: list[Column], purpose: str) -> DataFrame:
    """``df`` with ``rank`` (from 0) and ``width`` (rows) in its group. A hot group is cut into many ranges, never one window.

    Rows are dealt by ranges of (group, order) and written sorted, with their place in the range; the few places at which a
    group starts in a range, with the rows of the group in earlier ranges, give the rest. Rows equal in all of ``order`` get
    ranks in any order. Group columns hold no nulls.
    """
    spark = df.sparkSession
    keys = [F.col(c) for c in group]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *keys, *order, "_tie")
    placed = written(dealt.sortWithinPartitions(*keys, *order, "_tie").drop("_tie").withColumn(
        "_at", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    starts = placed.groupBy("_slice", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).withColumn(
        "width", F.sum("_rows").over(Window.partitionBy(*group))).drop("_rows")
    out = placed.join(starts, ["_slice", *group])
    return out.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_slice", "_at", "_first", "_before")


def joined(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", least: int = 4096) -> DataFrame:
    """``big`` join ``small`` (one row a key) where keys of ``big`` may be hot. ``big`` is stored, as it is read more than once.

    A key is hot with over a thousandth of the rows (and over ``least``): there are at most a thousand such keys, whose rows of
    ``small`` are broadcast. All other keys are shuffled.
    """
    bound = max(least, big.count() // 1000)
    hot = big.groupBy(*keys).count().where(F.col("count") > bound).drop("count").dropna()
    if hot.isEmpty():
        return big.join(small, keys, how)
    hot = written(hot, "hot-keys")
    found = written(small.join(F.broadcast(hot), keys, "left_semi"), "hot-rows")
    few = big.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(found), keys, how)
    return few.unionByName(big.join(F.broadcast(hot), keys, "left_anti").join(small, keys, how))


_SQL_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


def sql_crc32(numbers: str, name: str) -> str:
    """Recursive parts of a WITH clause of DuckDB: ``name`` (id, crc), the crc32 of the decimal text of ids from ``numbers``."""
    return f"""{name}_steps AS (
  SELECT id, CAST(id AS VARCHAR) AS digits, 0 AS k, 4294967295::BIGINT AS c FROM ({numbers})
  UNION ALL
  SELECT id, digits, k + 1, CASE WHEN k % 9 = 0 THEN xor(c, ascii(substr(digits, k // 9 + 1, 1))::BIGINT) ELSE {_SQL_BIT} END
  FROM {name}_steps WHERE k < 9 * length(digits)),
{name} AS (SELECT id, xor(c, 4294967295) AS crc FROM {name}_steps WHERE k = 9 * length(digits))"""
