"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize


def _min_join(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each row (u, v) with the smallest v of its u; and those minima alone."""
    mins = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(mins, "u"), mins


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges point to the smaller end."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined, _ = _min_join(both)
    large = (
        joined.where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .where("u > v")
        .distinct()
    )
    joined, mins = _min_join(large)
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(mins.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v: any comparable type, no
    nulls); ``root`` is its component's smallest node.

    Alternating large-star and small-star steps: every step is a map-side
    minimum and a join on the node, so a node with very many edges is
    pre-aggregated and its join partition can be split by AQE. The edge table
    is stored after each round (a lost executor re-reads it); rounds grow with
    the logarithm of the longest chain. Self-loops and repeated edges are
    allowed, an edge-less node isn't listed unless it has a self-loop.
    """
    loops = edges.where("u = v").select(F.col("u").alias("node")).distinct()
    now = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc"
    )

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = mark(now)
    while before[0]:
        now = materialize(_round(now), "cc")
        after = mark(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    linked = stars.unionByName(roots)
    return linked.unionByName(loops.join(linked, "node", "left_anti").select("node", F.col("node").alias("root")))
