"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import checkpointed, hot_join


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (u, v: long) to one row (node, component) per node that has an edge; component is its smallest node.

    Each step is one min-aggregation, which combines on the map side, and one equi-join that keeps the links of a hot
    node out of the shuffle; no neighbourhood is gathered. The edges of a round are checkpointed. Self-loops, repeated
    edges and nulls are dropped; no edges give an empty table. Rounds grow with the logarithm of the nodes; where
    ``max_rounds`` do not settle the edges, RuntimeError is raised rather than part of a result returned.
    """
    edges = checkpointed(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        edges = checkpointed(_small_star(_large_star(edges, state[0]), state[0]))
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    out = hot_join(both, least, "u", "n", 2 * total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = hot_join(edges, least, "u", "n", total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
