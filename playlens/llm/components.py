"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond"). Edges stay distributed; every round is written to the shared folder,
so a lost executor costs a re-read and the plan never grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.config import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an
    edge table (a, b). Nodes without an edge are not in the result; NULL nodes
    are ignored; an empty table gives an empty result."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialize(now.where("u > v").distinct(), "cc")
    state = _state(now)
    while True:
        now = materialize(_small_star(_large_star(now)), "cc")
        state, before = _state(now), state
        if state == before:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
