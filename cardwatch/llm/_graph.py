"""Connected components of a link table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import saved

MAX_ROUNDS = 60  # a round at least halves the depth; 60 would do for any table


def _pairs(df: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return (df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _are_stars(links: DataFrame) -> bool:
    """Has every larger node one smaller one, that has none itself?"""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    chained = links.join(links.select(F.col("b").alias("a")), "a", "left_semi").select("a")
    return several.unionByName(chained).limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of the component.

    Large-star and small-star steps in turn, each saved to the shared folder, until
    only stars are left. A step keeps one row per node and neighbour; a node with very
    many neighbours is pre-aggregated to its smallest and joined between two saved
    tables, which adaptive execution splits. Nothing is collected.
    """
    links = saved(_pairs(links), "links")
    for _ in range(MAX_ROUNDS):
        if _are_stars(links):
            break
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-low")
        large = saved(_pairs(both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))), "links-large")
        low = saved(large.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = saved(_pairs(small.unionByName(low.select("a", F.col("m").alias("b")))), "links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
