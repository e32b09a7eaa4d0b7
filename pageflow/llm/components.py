"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pulled(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour ``v`` of ``u`` is tied to the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    tied = edges.join(least, "u")
    moved = tied.where("v > u") if larger_only else tied.where("v != m")
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out if larger_only else out.union(least.where("u != m").select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (columns u, v); the component is its smallest node.

    Large stars tie all larger neighbours of a node to the smallest, small
    stars all smaller ones; the rounds grow with the logarithm of the longest
    chain. Minima are combined before the shuffle, and the join has one row a
    node on one side, so a hub is split by Spark's skew join.
    """
    edges = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pulled(both, True).where("u != v").distinct()
        edges = stored(_pulled(large, False).where("u != v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
