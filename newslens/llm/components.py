"""Connected components by alternating large and small stars, all in shuffled joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newslens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(
        F.least("a", "m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a < b: every b hangs its smaller neighbours on the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return joined.select(F.col("m").alias("a"), F.col("a").alias("b")).where(F.col("a") != F.col("b")) \
        .unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's least node.

    Self-links only name a node. Each round is stored, so no lineage grows; the
    number of rounds is logarithmic in the longest chain.
    """
    nodes = stored(edges.select("a").unionByName(edges.select(F.col("b").alias("a"))).distinct(), "nodes")
    now = stored(edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), "stars")
        new = mark(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.withColumnRenamed("a", "node").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))
