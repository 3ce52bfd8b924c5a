"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import write_once


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component, roots left out.

    ``edges`` has two long columns ``a`` and ``b``; order, repeats and loops don't matter. Every
    round is stored, so lost executors cost one round at most. Groups are only aggregated and
    joined, so adaptive execution can split a node with very many neighbours.
    """
    now = write_once(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = write_once(small.select("e.a", "e.b").filter(F.col("a") != F.col("b")).distinct(), "edges")
