"""Connected components of a distributed graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed


def _star(both: DataFrame, nodes_above: bool) -> DataFrame:
    """Each node's neighbours (above it, or below it and itself) joined to its least neighbour."""
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = both.join(least, "u")
    if nodes_above:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u <> v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u long, v long): root is the least node
    reachable. Self links and repeated links are allowed; nodes without links have no row.

    Each round turns neighbourhoods into stars around their least nodes; a logarithmic number of
    rounds suffices. Rounds end when the set of links no longer changes (their count and an
    order-free hash of them). Only those two numbers reach the driver.
    """
    now = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .filter("u <> v").distinct())
    seen = None
    while True:
        n, mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (n, mark) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (n, mark)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).distinct()  # (u, v) with v < u
        now = checkpointed(_star(large, False).distinct())
