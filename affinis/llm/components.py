"""Connected components of links, by alternating large and small stars on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.plans import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to the smallest among them and it.

    Large stars move the greater neighbours; small stars the others and the node.
    """
    sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    near = sides.unionAll(back).filter("u <> v")
    if not large:
        near = near.filter("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = near.join(least, "u")
    if large:
        return tied.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(own).filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one only, which itself has none."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionAll(edges.select(F.col("b").alias("u"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    nodes = ends.groupBy("u").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.filter("below + above > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of links (a, b): the smallest node it can reach.

    Rounds of two joins each, their number logarithmic in the longest path, until
    every component is a star around its smallest node; no rows come to the driver.
    A hub's many neighbours are aggregated before the shuffle and looked up by a join that
    adaptive execution splits.  Links of a node with itself are left out; no
    links give no nodes.
    """
    sides = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.filter("a <> b").select(*sides).distinct())
    while not _settled(edges):
        edges = stage(_stars(_stars(edges, True), False))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
