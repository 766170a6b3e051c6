"""Folds and bounded samples of labelled documents, for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learned from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def sample_of_labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents outside the held-out fold, in hash order: text and label.

    Labels of one document that disagree, and null labels or ids, are left out. The ids of the sample are few by construction.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    agreed = usable.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("top")).where("label = top").drop("top")
    few = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id").select("text", "label")
