"""Connected components of a graph given as a table of edges, for graphs of any size.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step is one aggregation and
one join, whatever the degree of a node. The edges of each round are written
to the shared folder; the driver sees only two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from coldshelf.llm.shared import written


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges(a, b)``; component is its smallest node.

    Edges with a null end and loops link nothing. Nodes without another node have no row.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")
    )
    edges = written(spark, edges.distinct(), "edges")
    before = None
    while True:
        edges = written(spark, _small_star(_large_star(edges)), "edges")
        now = _digest(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("to").alias("node")).distinct()
    return edges.select("node", F.col("to").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _digest(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest among it and all its neighbours."""
    both = edges.select("node", "to").union(edges.select(F.col("to"), F.col("node")).toDF("node", "to"))
    least = both.groupBy("node").agg(F.min("to").alias("low")).select("node", F.least("node", "low").alias("low"))
    return (
        both.where(F.col("to") > F.col("node"))
        .join(least, "node")
        .select(F.col("to").alias("node"), F.col("low").alias("to"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("node").agg(F.min("to").alias("low"))
    moved = edges.join(least, "node").select(F.col("to").alias("node"), F.col("low").alias("to"))
    return moved.union(least.toDF("node", "to")).where(F.col("node") != F.col("to")).distinct()
