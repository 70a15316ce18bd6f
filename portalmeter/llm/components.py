"""Connected components by star contraction, for links of any number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalmeter.llm.words import Scratch


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the smallest node of the neighbourhood."""
    both = _both(links)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its neighbours below are linked to the smallest of these."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for each node of the links (u, v); root is the smallest node it is connected to.

    Large-star and small-star steps alternate until the links stop changing, which takes a number of rounds that
    grows with the logarithm of the size. Only sums of hashes reach the driver. Links of a node to itself are
    ignored; no links give no rows. A node with very many links is one row of the small side of each join.
    """
    star = scratch.save(links.where("u <> v").select("u", "v").distinct(), f"{name}-0")
    seen = None
    for step in range(1, 200):
        star_next = scratch.save(_small_star(_large_star(star)).where("u <> v").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        star = star_next
        state = tuple(star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("the links did not settle into components")
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).union(star.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
