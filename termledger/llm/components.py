"""Connected components of a graph that is stored as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.llm.common import never_broadcast


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    up = never_broadcast(both.where("v > u"), 2 * rows)
    return up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.min("u"), F.max("u")
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame, folder) -> DataFrame:
    """Per node that has an edge and isn't the least of its component: (u, v),
    v being the least node of the component.

    Alternating large and small stars: every round hangs the neighbours of each
    node below the least of them, so the rounds grow with the logarithm of the
    longest path squared at most. Each round is one written table in the shared
    folder, which cuts the lineage; minima combine before the shuffle, and the
    join that follows is one the planner can split when a node has many edges.
    """
    edges = folder.write(_small_star(edges))
    seen = _digest(edges)
    while True:
        edges = folder.write(_small_star(_large_star(edges, seen[0])))
        now = _digest(edges)
        if now == seen:
            return edges
        seen = now
