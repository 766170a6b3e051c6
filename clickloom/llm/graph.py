"""Connected components of links, by alternating large-star and small-star steps. Nothing is collected; keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u > v. Large: neighbours above u go to u's smallest neighbour; small: u and those below do."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node points to one other, which points nowhere."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("root") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links`` (columns a, b): root is the smallest id that links lead to."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _settled(edges):
        edges = written(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
