"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u long, v long); a component's id is its smallest node.

    Every round is one aggregate and one join on a node; minima are partial before the shuffle, and a node with very many
    neighbours is a skewed join key that adaptive execution splits. Rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder, so a lost executor costs at most the round it was in.
    """
    edges = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = saved(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        # a forest of stars is the fixed point: then a round changes neither the number of edges nor the sum of their ends
        now = tuple(edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
