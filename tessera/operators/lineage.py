"""Lineage of released files: all that they were made from, however many steps back, and what is made from itself.

A round follows every link of the last round's finds once, as an equi-join, and keeps what is new; finds are written by round, so that no
plan grows with the depth and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sources_of(roots: DataFrame, made_from: DataFrame, folder: str) -> DataFrame:
    """(root, node, depth): for each root (root) all nodes that it was made from, with the fewest steps; the root itself has depth 0.

    made_from: (node, source), repeats allowed; links with a null end and null roots take no part. folder: a new folder that all executors share.
    Cycles end as what is known is not followed again.
    """
    spark = roots.sparkSession
    links = made_from.select("node", "source").where("node is not null and source is not null").distinct()
    front = roots.where("root is not null").select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct()
    schema, depth = "root string, node string, depth int", 0
    front.select(F.col("root").cast("string"), F.col("node").cast("string"), "depth").write.parquet(f"{folder}/round-0")
    while True:
        known = spark.read.schema(schema).parquet(*[f"{folder}/round-{k}" for k in range(depth + 1)])
        last = spark.read.schema(schema).parquet(f"{folder}/round-{depth}")
        if last.isEmpty():
            return known
        depth += 1
        new = last.join(links, "node").select("root", F.col("source").cast("string").alias("node")).distinct().join(known, ["root", "node"], "left_anti")
        new.withColumn("depth", F.lit(depth)).select("root", "node", "depth").write.parquet(f"{folder}/round-{depth}")


def cyclic(made_from: DataFrame, folder: str) -> DataFrame:
    """(node): the nodes that lie on a cycle of made_from (node, source), or on a way from one cycle to another; none if there is no cycle.

    Links whose node nothing is made from, or whose source is made from nothing, are cut off until none is left to cut.
    """
    spark = made_from.sparkSession
    schema, k = "node string, source string", 0
    made_from.where("node is not null and source is not null").select(F.col("node").cast("string"), F.col("source").cast("string")).distinct().write.parquet(f"{folder}/cut-0")
    while True:
        now = spark.read.schema(schema).parquet(f"{folder}/cut-{k}")
        kept = now.join(now.select(F.col("source").alias("node")).distinct(), "node", "left_semi").join(now.select(F.col("node").alias("source")).distinct(), "source", "left_semi")
        k += 1
        kept.select("node", "source").write.parquet(f"{folder}/cut-{k}")
        if spark.read.schema(schema).parquet(f"{folder}/cut-{k}").count() == now.count():
            return now.select("node").distinct()


def release_manifest(inventory: DataFrame, roots: DataFrame, made_from: DataFrame, folder: str) -> DataFrame:
    """(root, node, depth, sha256, size): the lineage of released files with the hash and size that the inventory (path, sha256, size) has of each;
    null for a file that it lacks."""
    return sources_of(roots, made_from, folder).join(inventory.select(F.col("path").alias("node"), "sha256", "size"), "node", "left").select("root", "node", "depth", "sha256", "size")
