"""Connected components of links, by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    Each round points all larger neighbours of a node at its smallest one, then
    all smaller ones.  The edges get no more, the longest path about halves,
    and a node with very many links is only ever a key of partial minima and of a
    join that can be split.  Each round is written to the shared folder, so
    a lost executor repeats one round at most.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = stage(links.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "star")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
