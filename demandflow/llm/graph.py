"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import Scratch


def _stars(edges: DataFrame) -> bool:
    """Whether every node of these distinct edges is either a centre or has one edge, to its centre."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    nodes = nodes.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    other = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)")
    return not other.limit(1).count()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(u, v)`` edges -> ``(node, component)``: the smallest node of each component, for every
    node that has an edge to another one.  Each step is joins and aggregations; stars are never
    gathered, a centre's neighbours meet only as a minimum.  Self-edges, nulls and repeated
    edges change nothing."""
    e = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = scratch.write(e, "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, "large")
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = scratch.write(small.unionByName(parent.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(e, large)
        e = nxt
    roots = e.select(F.col("v").alias("node")).distinct()
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.unionByName(roots.select("node", F.col("node").alias("component")))
