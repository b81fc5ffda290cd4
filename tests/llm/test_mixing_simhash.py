from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import components, mixing, simhash


def plain_targets(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, (s, _) in enumerate(order)}
    cap = {s: 2.0 * n for s, n in order}
    left, free, out = 1.5 * sum(n for _, n in order), {s for s, _ in order}, {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = cap[s]
            left -= cap[s]
        free -= over
    return out


def test_targets_brute_force(spark):
    rng = random.Random(2)
    for sizes in ([("a", 10), ("b", 1000), (None, 5)], [("x", 0), ("y", 0)], [("s", 7)], [(f"s{i}", rng.randint(0, 500)) for i in range(15)]):
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", None])) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed, sources = mixing.mix_with_sources(docs)
    got = mixing.curriculum(mixed, mixing.tilted(sources)).collect()
    assert len(got) == 500 and all(0 <= r.taken <= 2 * r.size for r in got)
    for s in ("a", "b", None):
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == round(own[0].target)
    assert all((r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1) for r in got)
    shuffled = spark.createDataFrame(rng.sample(rows, len(rows)), docs.schema).repartition(5)
    again = mixing.curriculum(*(lambda m, s: (m, mixing.tilted(s)))(*mixing.mix_with_sources(shuffled))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_position_inverts_the_demand(spark):
    """At a document's position the schedule has asked for as many words as stand before it."""
    mixed = spark.createDataFrame([("a", 100, k * 10, 10) for k in range(10)], "source string, source_size long, before long, taken long").withColumn("doc_id", F.monotonically_increasing_id())
    plan = spark.createDataFrame([("a", 0.0, 0.5, 0.0, 2.0), ("a", 0.5, 1.0, 2.0, 0.0)], "source string, t0 double, t1 double, w0 double, w1 double")
    met = lambda t: (2 * t * t if t <= 0.5 else 1 - 2 * (1 - t) ** 2)  # noqa: E731  of an area of 1
    for r in mixing.curriculum(mixed, plan).collect():
        assert abs(met(r.position) - r.before / 100) < 1e-9


def test_every_pass_inverts_the_demand_for_the_taken_words(spark):
    """At each position of a row, the schedule has asked for as many words as its source has given by then."""
    met = lambda t: (2 * t * t if t <= 0.5 else 1 - 2 * (1 - t) ** 2)  # noqa: E731  of an area of 1
    for goal in (65, 100, 135, 200):
        whole, rest = divmod(goal, 100)
        rows = [("a", k, 10, 100, float(goal), k * 10, whole * 10 + max(0, min(10, rest - k * 10))) for k in range(10)]
        mixed = spark.createDataFrame(rows, "source string, doc_id long, size long, source_size long, target double, before long, taken long")
        plan = spark.createDataFrame([("a", 0.0, 0.5, 0.0, 2.0), ("a", 0.5, 1.0, 2.0, 0.0)], "source string, t0 double, t1 double, w0 double, w1 double")
        for schedule, asked in ((plan, met), (plan.where("false"), lambda t: t)):
            got = mixing.curriculum_by_pass(mixed, schedule).collect()
            found = sorted(asked(t) * goal for r in got for t in r.positions or [])
            assert len(found) == -(-goal // 10) and all(abs(x - 10 * i) < 1e-6 for i, x in enumerate(found))
            assert all(r.position == (r.positions[0] if r.taken else None) for r in got)


def test_rows_that_tie_are_placed_one_after_another(spark):
    """An id that many rows share, and rows without one, fill their place in the order without gaps or overlaps."""
    rng = random.Random(6)
    sizes = [(None if rng.random() < 0.4 else 7 if rng.random() < 0.5 else i, rng.choice(["a", None]), rng.randint(0, 3)) for i in range(300)]
    got = mixing.placed(spark.createDataFrame(sizes, "doc_id long, source string, size long"), chunk=7).collect()
    for s in ("a", None):
        own = sorted((r.before, r.size) for r in got if r.source == s)
        assert sorted(n for _, n in own) == sorted(n for _, x, n in sizes if x == s)
        at = 0
        for before, n in own:
            assert before == at
            at += n


def test_mixing_odd_rows(odd_docs, no_docs):
    mixed, sources = mixing.mix_with_sources(odd_docs)
    rows = mixed.collect()
    assert len(rows) == odd_docs.count() and all(r.size == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert mixing.mix_with_sources(no_docs)[0].count() == 0


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split("\n")
    words = [w for line in words for w in line.replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints_brute_force(odd_docs):
    want = sorted(((r.doc_id, plain_fingerprint(r.text)) for r in odd_docs.collect()), key=str)
    got = sorted(((r.id, r.fp % (1 << 64)) for r in simhash.fingerprints(odd_docs).collect()), key=str)
    assert got == want


def test_trie_pairs_brute_force():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(12)]))
    y = np.unique(x[rng.random(len(x)) < 0.6] ^ np.uint64(5))
    for a, b, same in ((x, x, True), (x, y, False)):
        roots = tuple(np.array([v]) for v in (0, len(a), 0, len(b)))
        got = {(int(i), int(j)) for p in simhash.trie_pairs(a, b, roots, same, 4, leaf=4, chunk=50) for i, j in zip(*p, strict=True)}
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if (i < j or not same) and int(a[i] ^ b[j]).bit_count() <= 4}
        assert got == want


def test_components_and_shards_brute_force(spark):
    rng = np.random.default_rng(9)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 63, 6, dtype=np.uint64) ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))) for _ in range(60)]))
    want = {int(f): int(f) for f in fps}

    def root(f: int) -> int:
        while want[f] != f:
            f = want[f]
        return f

    for i, f in enumerate(fps.tolist()):
        for g in fps.tolist()[i + 1 :]:
            if (f ^ g).bit_count() <= 4:
                a, b = sorted((root(f), root(g)))
                want[b] = a
    df = spark.createDataFrame([(int(f.view(np.int64)),) for f in fps], "fp long")
    for rows in (20_000, 7):
        found = components.components(simhash.links(df, group_rows=rows)).collect()
        groups: dict[int, set] = {}
        for r in found:
            groups.setdefault(r.root, set()).add(r.node % (1 << 64))
        plain: dict[int, set] = {}
        for f in want:
            plain.setdefault(root(f), set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(s) for s in plain.values() if len(s) > 1)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 130)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.id in (3, 4, 5)} == {3}
    assert {r.component_id for r in rows if r.id == 1} >= {1}
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and [r.doc_id for r in kept.collect() if r.doc_id in (3, 4, 5)] == [3]


def test_near_duplicates_whole_query_brute_force(spark):
    """Fingerprints, links and components end to end, against all pairs."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + i, " ".join((t or "").split()[: 4 + i % 40])) for i, (_, t) in enumerate(rows[:60])] + [(None, rows[0][1]), (7, ""), (8, None), (7, rows[1][1])]
    fps = [plain_fingerprint(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least: dict[int, int] = {}
    for (d, _), p in zip(rows, part, strict=True):
        if d is not None:
            least[p] = min(d, least.get(p, d))
    want = sorted(((d, f, least.get(p)) for (d, _), f, p in zip(rows, fps, part, strict=True)), key=str)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_one_row_of_each_group_stays(spark):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen"
    rows = [(1, b), (5, b), (5, a), (None, a), (None, a), (None, c), (None, c), (6, c + " more"), (6, c + " more"), (9, None), (None, "")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, b), (5, a), (None, c), (6, c + " more"), (9, None)], key=str)


def test_clashing_columns_keep_their_values(odd_docs, clashing):
    clashing(simhash.one_of_each(odd_docs), odd_docs)
