"""Connected components of a graph given as links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.scratch import stage

_MAX_ROUNDS = 100


def component_roots(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (``u``, ``v``): root is the smallest node reachable.

    Each round points every node's larger neighbours, then its smaller ones, at the smallest
    node near it.  Rounds grow with the logarithm of the longest path.  A round is two joins on
    the node with one row per node on one side; the links are staged after it, so no lineage
    builds up.  Nothing but two totals reaches the driver.
    """
    current = stage(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = None
    for _ in range(_MAX_ROUNDS):
        totals = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if totals == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = totals
        current = stage(_small_star(_large_star(current)), "links")
    raise RuntimeError("components did not settle")


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours larger than a node are linked to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u")
    others = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
