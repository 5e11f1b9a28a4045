"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import drop_table, materialised


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest neighbour or the node itself."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    tied = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node that links reach. Each step is written.

    ``rows``: how many edges there are at most, if known; no step has more than the one before.
    """
    spark = edges.sparkSession
    edges, path = materialised(edges.select("a", "b").filter("a <> b").distinct(), "edges", rows)
    state = None
    while True:
        stepped, new_path = materialised(_small(_large(edges)), "edges", rows)
        now = stepped.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("a", "b"), 20))).first()
        drop_table(spark, path)
        edges, path = stepped, new_path
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
