"""Connected components of an edge table by alternating star contraction, as joins and partial aggregates.

Each round replaces every node's larger neighbours by links to its smallest neighbour (large star), then
links each node's smaller neighbours to the smallest of them (small star). Both steps are one aggregate and
one equi-join on the node, so that a node with very many neighbours is combined map-side and its join
partition can be split by AQE; no neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node long, root long) for every node of edges (u long, v long): root is the smallest node it reaches.

    Null ends and self loops are left out; an empty edge table gives an empty result.
    """
    now = written(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u is not null and v is not null and u <> v"))
    seen = None
    while (state := _digest(now)) != seen:
        seen = state
        now = written(_small_star(_large_star(now)))
    stars = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
