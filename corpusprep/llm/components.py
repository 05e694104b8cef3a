"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: bigint): the root is the component's smallest node.

    Each round points all larger neighbours of a node to its smallest neighbour (large star), then all
    smaller ones (small star); edges only shrink towards roots, and a few rounds suffice even for long
    chains.  Minima are pre-aggregated, so a hub's neighbours never meet in one group.
    """
    u, v = F.col("u"), F.col("v")
    edges = stage(links.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), f"{name}_edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct())
        edges = stage(small, f"{name}_edges")
        before, state = state, _state(edges)
        if state == before:
            break
    # a star for each component: its smallest node in the middle
    return edges.select(u.alias("node"), v.alias("root")).unionByName(edges.select(v.alias("node"), v.alias("root")).distinct())
