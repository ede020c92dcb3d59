"""Connected components by alternating stars.

Each round points every node's larger neighbours at its smallest one (large
star), then its smaller neighbours (small star), until the edges no longer
change; a node with very many neighbours is shortened by half its depth in each
round. All work is aggregation and equi-joins on edges; what a round leaves is
staged, so lineage stays short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelsmith.llm.scratch import stage


def _star(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v): every v above u's smallest neighbour, or u itself, points to that smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(pairs: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``pairs`` (a, b: long) -> node, component (its smallest node) for all nodes that have an edge."""
    edges = stage(pairs.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _print(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)  # every neighbour v is below u here, so m is the smallest of them
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        edges = stage(small, "edges")
        after = _print(edges)
        if after == before:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
