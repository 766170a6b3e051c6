"""From raw documents to packed training sequences: the stages in order, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.common import shared_folder, table
from clickloom.llm.mixing import mix
from clickloom.llm.near_dedup import drop_near_copies
from clickloom.llm.packing import pack
from clickloom.llm.quality_rules import clean
from clickloom.llm.suffix_dedup import remove_repeats

#: Bytes of a repeated passage, and of the grams that find it: fifty words are longer than this in any language of the corpus.
PASSAGE_BYTES, PASSAGE_GRAM = 200, 64

#: (name, function of (spark, docs, sf_dir)). All but the last return the columns of documents.
STAGES = [
    ("quality rules", lambda spark, docs, sf_dir: clean(docs)),
    ("near duplicates", lambda spark, docs, sf_dir: drop_near_copies(docs)),
    ("repeated passages", lambda spark, docs, sf_dir: remove_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM)),
    ("source mix", lambda spark, docs, sf_dir: mix(docs)),
    ("packing", lambda spark, docs, sf_dir: pack(docs)),
]

#: SQL can't express the stages from the second on; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. Every stage's rows are written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = shared_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
