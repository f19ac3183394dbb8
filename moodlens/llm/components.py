"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour (or the node itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and all its smaller neighbours to the smallest of them. Edges point from x down to y."""
    least = edges.groupBy("x").agg(F.min("y").alias("m"))
    moved = edges.join(least, "x").where("y <> m").select(F.col("m").alias("a"), F.col("y").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("x").alias("b"))
    return moved.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``, root being the component's smallest node.

    Alternating stars until nothing changes. Each round is written to the shared folder; smallest neighbours are
    partial aggregates and hubs are split by skew joins, so no component is ever gathered in a task. An empty
    edge table gives no rows; loops are ignored and repeated edges count once.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        before = now
        edges = stored(_small_star(_large_star(edges)), "edges")
