"""Connected components of a graph of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtmart.llm import shared as S


def _figures(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v), root being the smallest node that it reaches, itself included.

    Each round points the larger neighbours of every node, then the node itself and its smaller neighbours, to the
    smallest one. No neighbour list is gathered: rounds are a minimum per node and a join with it, which the adaptive
    planner can split for a hub. Every round is a written table, so lost executors cost one round at most.
    """
    ordered = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = S.stored(ordered.distinct(), "links")
    before = _figures(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = least.select("u", F.col("m").alias("v"))
        edges = S.stored(moved.unionByName(kept).distinct(), "links")
        after = _figures(edges)
        if after == before:
            break
        before = after
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
