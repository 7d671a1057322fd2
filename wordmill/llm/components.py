"""Connected components by alternating large-star and small-star joins (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.scratch import stored


def _stars(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step over directed pairs (u, v): neighbours point at the smallest one."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = pairs.join(least, "u")
    moved = joined.where("v > u" if large else "v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.where("u != m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the long columns ``a``, ``b``; the component is its smallest node.

    Each round is written to the shared folder; rounds grow with the logarithm of the
    longest chain. Hot nodes are absorbed by partial aggregation and split by skew joins.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "components")
    mark = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _stars(both, large=True)
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = stored(_stars(down, large=False), "components")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
