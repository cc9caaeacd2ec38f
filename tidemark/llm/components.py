"""Connected components of a link table by alternating star contraction.

Each round is two grouped minima and two joins, all on partially aggregated
keys, and is written to the shared folder before the next. No node's
neighbours are ever gathered in one task: a hub with a third of all links
is reduced to its minimum before the shuffle, and its rows in the join can
be split by the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle


def _stars_remain(edges: DataFrame) -> bool:
    """True when every node points at one root and no root points anywhere."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out")).union(
        edges.select(F.col("v"), F.lit(0)))
    bad = ends.groupBy("n").agg(F.sum("out").alias("outs"), F.sum(1 - F.col("out")).alias("ins")).where(
        (F.col("outs") > 1) | ((F.col("outs") > 0) & (F.col("ins") > 0)))
    return bad.isEmpty()


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (longs) of every node that has a link; component = smallest node reachable.

    ``links`` holds undirected pairs in columns ``a`` and ``b``; loops, repeated
    pairs and rows with a null end are ignored. No links give no rows.
    """
    edges = settle(
        links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    for _ in range(max_rounds):
        if _stars_remain(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        # every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # then a node and all its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        edges = settle(small, "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
