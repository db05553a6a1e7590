"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) joined back to the links, so no node's neighbours
are gathered; hot nodes split under adaptive skew joins. Every step is cut by a checkpoint, and what a round leaves
behind is released.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import cut, packed, release


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another node.

    Null ends and links of a node to itself are left out.
    """
    edges = packed(cut(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()))
    before = _state(edges)
    while before[0]:
        edges = packed(cut(_small_star(packed(cut(_large_star(edges))))))
        after = _state(edges)
        release(links.sparkSession)
        if after == before:
            break
        before = after
    roots = edges.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
