"""Connected components by large-star and small-star rounds (A10).

Each round hooks every node's larger neighbours, then its smaller ones, to its smallest
neighbour; the number of rounds grows with the logarithm of the longest chain. Minima are
partial aggregates and joins are plain equi-joins, so a node with very many links is split
like any skewed key. There is one method for every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table


def _hook(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over links (u, v) with u > v."""
    both = edges
    if larger:
        both = edges.select(F.explode(F.array(
            F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return out.where("u > v").distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node either has links to it only, or one link to a node that has such only."""
    sides = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("s")).select("s.*")
    seen = sides.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.filter((F.col("out") > 1) | (F.col("out") + F.col("into") > 1)).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of `links`, columns a and b (long).

    Links of a node with itself are ignored; repeated links count once; no links give no rows.
    """
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u > v").distinct())
    while not _only_stars(edges):
        edges = stage_table(_hook(_hook(edges, larger=True), larger=False))
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Add `component` to `nodes(node)` for undirected `edges(a, b)` of longs."""
    found = components(edges)
    return stage_table(nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
