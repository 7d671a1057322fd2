"""Connected components by alternating large-star and small-star joins (Kiveris et al., 2014)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.session import checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read again: lineage ends at its files."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step over directed pairs (u, v): neighbours point at the smallest one of a node's star."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = pairs.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u"))
        return moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.where(F.col("u") != F.col("m")).select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the columns ``a``, ``b`` (any orderable type): its smallest node.

    A round halves long chains, so rounds grow with the logarithm of the longest one. Each
    round's edges are written to the shared folder; no pair beyond the given edges is made.
    """
    edges = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, large=True).where(F.col("a") != F.col("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = written(_star(down, large=False).where(F.col("a") != F.col("b")).distinct(), "components")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
