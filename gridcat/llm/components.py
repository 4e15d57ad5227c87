"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges``; ``root`` is the least
    node of its component.  Loops and repeated edges do no harm; null ends are
    ignored; no edges give no rows.

    Each step is one aggregate (least neighbour, partial sums first) and one
    equi join, whose hot keys adaptive execution splits; nothing is collected.
    The steps are written to the shared folder, so lineage stays short, and
    their number is logarithmic in the number of nodes.
    """
    links = stored(
        edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
        .where("low < high and low is not null").distinct(), "links")
    before = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        # equal checksums over the edge set mean that the last step changed nothing
        now = links.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return leaves.unionByName(roots.join(leaves, "node", "left_anti"))


def _large_star(links: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the node's least neighbour."""
    both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
        links.select(F.col("high").alias("u"), F.col("low").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("m").alias("low"), F.col("v").alias("high"))
            .where("low < high").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them."""
    least = links.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
    smaller = links.join(least, links.high == least.u)
    return (smaller.select(F.col("m").alias("low"), F.col("low").alias("high"))
            .unionByName(least.select(F.col("m").alias("low"), F.col("u").alias("high")))
            .where("low < high").distinct())
