from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """(root, path of each node): lists of what stands left and right on each level."""
    paths: list[list] = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_no, i in enumerate(at):
            run = nodes[i // fanout * fanout : i // fanout * fanout + fanout]
            paths[leaf_no].append((run[: i % fanout], run[i % fanout + 1 :]))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def brute(rows: list[tuple], fanout: int = 3) -> list[tuple]:
    """Rows of (doc_id, leaf, subroot, root, proof, folded_root, verified), by a plain walk."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
        trees[name] = (members, *climb([leaf(r) for r in members], fanout))
    root, above = climb([trees[n][1] for n in names], fanout)
    out = []
    for k, name in enumerate(names):
        members, subroot, paths = trees[name]
        for r, path in zip(members, paths, strict=True):
            whole = path + above[k]
            changed = r[4].replace("\n", "") if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]
            folded = leaf((*r[:4], changed))
            for left, right in whole:
                folded = h(*left, folded, *right)
            out.append((r[0], leaf(r), subroot, root, h(*[d for left, right in whole for d in left + right]), folded, folded == root))
    return sorted(out, key=str)


def got(df, **settings) -> list[tuple]:
    found = merkle.verified(df, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return sorted((tuple(r) for r in found.collect()), key=str)


def sample(n: int, sources: list, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    return [(i, rng.choice(sources), rng.choice(["en", None, ""]), rng.choice([None, 0, 12345]), rng.choice(["a\nb", "plain", "", None, "é\n日本", f"text {i}\n"])) for i in ids]


@pytest.mark.parametrize(("n", "sources"), [(1, ["a"]), (3, ["a"]), (4, [None]), (60, ["a", "b", None, "", "Z", "é", "\U0001f600", "￿"]), (400, ["hot"] * 9 + list("bcdefghijkl"))])
def test_brute_force(spark, n, sources):
    rows = sample(n, sources, n)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_every_size_of_a_source(spark):
    rows = [(100 * k + i, f"s{k:02d}", "en", i, f"t{i}\n") for k in range(1, 31) for i in range(k)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


@pytest.mark.parametrize(("fanout", "band"), [(3, 1), (3, 2), (2, 3), (5, 2)])
def test_bands_and_fanouts_give_the_same_tree(spark, fanout, band):
    rows = sample(150, ["a"] * 5 + ["b", None], 9)
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), fanout=fanout, band=band)
    rows_got = sorted(((r.doc_id, r.leaf, r.subroot, r.root, h(*[s.l + s.r for s in r.path])) for r in found.collect()), key=str)
    assert rows_got == sorted([w[:5] for w in brute(rows, fanout)], key=str)
    assert found.where("folded_root <> root").count() == 0


def test_a_changed_row_is_found(spark):
    rows = sample(50, ["a", "b"], 2)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r[0] for r in rows if r[4] and "\n" in r[4] and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert want and {r.doc_id for r in merkle.verified(df, F.crc32(F.col("doc_id").cast("string")) % 2 == 0).where("not verified").collect()} == want


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got(odd_docs) == brute(rows)
    assert got(no_docs) == []


def test_equal_rows_spread_over_ranges(spark):
    rows = [(1, "a", "en", 1, "x")] * 300 + [(i, "a", "en", 1, f"x{i}") for i in range(2, 60)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)
    placed = merkle.numbered(spark.createDataFrame([("a", 1)] * 300 + [("b", i) for i in range(9)], "g string, o int").repartition(6), ["o"])
    assert sorted(r.i for r in placed.where("g = 'a'").collect()) == list(range(300)) and placed.where("n not in (300, 9)").count() == 0
