"""Connected components by rounds of joins, for edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assaymill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternates two steps until the edges are stars. Each node hands its larger
    neighbours to its smallest one, then its smaller neighbours. Both are a minimum per
    node, which sums up before the shuffle, and a join with it, whose hot keys Spark
    splits. Every round is written to the shared folder, so a lost executor costs one
    round at most.
    """
    edges = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # Larger neighbours of a node move to its smallest neighbour.
        large = both.filter("b > a").join(low, "a").selectExpr("b a", "low b").filter("a <> b").distinct()
        large = written(large, "large")
        # Smaller neighbours, and the node itself, move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").selectExpr("b a", "low b").union(low.selectExpr("a", "low b")).filter("a <> b")
        edges = written(small.distinct(), "small")
        # Equal sums of hashes of the edges mean equal edges: nothing moved, all edges point at roots.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.selectExpr("a node", "b root")
        before = now
