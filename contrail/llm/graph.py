"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_path, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and
    all its neighbours. Edges are (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
    return edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"),
                                                        F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v: integer ids, any
    order, repeats and loops allowed): the least id that the node reaches. Nulls
    link nothing. Neighbourhoods are never gathered: minima are aggregated and
    joined back, so that a hub is spread like any other skewed join key."""
    spark = links.sparkSession
    edges = (links.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                          F.least("u", "v").alias("v")).distinct())
    before, last = None, None
    while True:
        path = scratch_path(spark, "components")
        edges = cut_lineage(edges if last is None else _small_star(_large_star(edges)), path=path)
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if last:
            drop_path(spark, last)
        if state[0] == 0 or state == before:  # a forest of stars stays as it is
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        before, last = state, path
