from __future__ import annotations

import os
import random

from tessera.operators import lineage


def walked(roots: list[str], links: list[tuple[str, str]]) -> set[tuple[str, str, int]]:
    out = set()
    for root in roots:
        depth, front = {root: 0}, [root]
        while front:
            new = []
            for n in front:
                for m, s in links:
                    if m == n and s not in depth:
                        depth[s] = depth[n] + 1
                        new.append(s)
            front = new
        out |= {(root, n, d) for n, d in depth.items()}
    return out


def test_lineage_equals_a_walk(spark, tmp_path):
    rng = random.Random(2)
    links = [(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(40)]
    roots = ["n0", "n1", "n2", "alone"]
    df = spark.createDataFrame([*links, *links[:5], (None, "n1"), ("n1", None)], "node string, source string")
    got = {tuple(r) for r in lineage.sources_of(spark.createDataFrame([(r,) for r in [*roots, None]], "root string"), df, os.fspath(tmp_path / "a")).collect()}
    assert got == walked(roots, links)


def test_cycles_are_found_and_trees_have_none(spark, tmp_path):
    tree = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]
    assert lineage.cyclic(spark.createDataFrame(tree, "node string, source string"), os.fspath(tmp_path / "t")).count() == 0
    ring = [*tree, ("d", "e"), ("e", "b"), ("x", "x")]
    assert {r.node for r in lineage.cyclic(spark.createDataFrame(ring, "node string, source string"), os.fspath(tmp_path / "r")).collect()} == {"b", "d", "e", "x"}


def test_a_manifest_names_what_the_inventory_lacks(spark, tmp_path):
    inventory = spark.createDataFrame([("a", "h1", 3), ("b", "h2", 4)], "path string, sha256 string, size long")
    links = spark.createDataFrame([("a", "b"), ("b", "c")], "node string, source string")
    rows = lineage.release_manifest(inventory, spark.createDataFrame([("a",)], "root string"), links, os.fspath(tmp_path / "m")).collect()
    assert sorted(map(tuple, rows)) == [("a", "a", 0, "h1", 3), ("a", "b", 1, "h2", 4), ("a", "c", 2, None, None)]
