"""Connected components of a link table by alternating star contractions
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Each step is a minimum per node (aggregated before the shuffle) looked up by
the node's links; a node with very many links is spread over salted tasks. The
links are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import materialize, salted_lookup


def _star(links: DataFrame, least: DataFrame) -> DataFrame:
    return salted_lookup(links, "u", least, ["v"], how="inner")


def large_star(links: DataFrame) -> DataFrame:
    """Ties each neighbour above a node to the least of the node's neighbourhood."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return _star(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Ties a node and its lower neighbours to the least of them (links have u > v)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    low = _star(links, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that has a link; the root is the least
    node of the component. ``links``: two columns of one ordered type."""
    a, b = links.columns
    links = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = materialize(links.distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h"),
                          F.sum((F.xxhash64("u", "v") % 1_000_003)).alias("x")).first()
        if seen == state or not state.n:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = state
        links = materialize(small_star(large_star(links)), "links")
