from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import align


def lcs(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return row[-1]


def valid(runs: list, a: list, b: list) -> int:
    """Number of matches, after checking that they are equal entries in rising order."""
    pairs = sorted((i + k, j + k) for i, j, n in runs for k in range(n))
    assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    return len(pairs)


LISTS = st.lists(st.integers(0, 6), max_size=30)


@settings(max_examples=400, deadline=None)
@given(LISTS, LISTS)
def test_common_runs_are_a_longest_common_subsequence(a, b):
    assert valid(align.common_runs(a, b), a, b) == lcs(a, b)


@settings(max_examples=600, deadline=None)
@given(st.integers(0, 10**9), st.integers(0, 60), st.integers(0, 8), st.sampled_from([3, 10, 1000]))
def test_pieces_and_gaps_together_are_minimal(seed, size, edits, kinds):
    """What the anchors settle, with the gaps solved exactly, is as long as a longest common subsequence."""
    rng = random.Random(seed)
    a = [rng.randrange(kinds) for _ in range(size)]
    b = list(a)
    for _ in range(edits):
        at = rng.randrange(len(b) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            b.insert(at, rng.randrange(kinds))
        elif kind == 1 and b:
            del b[min(at, len(b) - 1)]
        elif kind == 2 and b:
            b[min(at, len(b) - 1)] = rng.randrange(kinds)
        elif b:  # move a stretch
            n = rng.randrange(1, 8)
            cut, b[at : at + n] = b[at : at + n], []
            to = rng.randrange(len(b) + 1)
            b[to:to] = cut
    keep_a, keep_b = [x for x in a if x in b], [x for x in b if x in a]
    runs, gaps = align.pieces(keep_a, keep_b)
    for i0, i1, j0, j1 in gaps:
        runs = runs + [(i0 + i, j0 + j, n) for i, j, n in align.common_runs(keep_a[i0:i1], keep_b[j0:j1])]
    assert valid(runs, keep_a, keep_b) == lcs(a, b)


def test_anchors_that_are_on_no_minimal_script_do_not_cut():
    a, b = ["u", "a", "a", "a"], ["a", "a", "a", "u"]
    assert align.pieces(a, b) == ([], [(0, 4, 0, 4)]) and valid(align.common_runs(a, b), a, b) == 3


def test_a_long_document_falls_into_short_gaps():
    rng = random.Random(1)
    a = [f"line {i}" if i % 5 else "" for i in range(200_000)]
    b = list(a)
    for at in rng.sample(range(len(b)), 40):
        b[at : at + 2] = ["", f"new {at}", ""]
    in_a, in_b = set(a), set(b)
    runs, gaps = align.pieces([x for x in a if x in in_b], [x for x in b if x in in_a])
    assert sum(i1 - i0 for i0, i1, _, _ in gaps) < 2000
    assert sum(n for _, _, n in runs) > 199_000


def frame(spark, docs: dict[str, list[str]]):
    return spark.createDataFrame([(k, i, t) for k, lines in docs.items() for i, t in enumerate(lines)], "k string, i int, t string").repartition(3)


def sample(rng: random.Random, lines: list[str]) -> list[str]:
    out = list(lines)
    for _ in range(rng.randrange(6)):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.randrange(3)] = [rng.choice(["x", "", "new", "b"])] * rng.randrange(3)
    return out


def test_counts_changes_and_matches_of_many_documents(spark):
    rng = random.Random(5)
    old = {f"d{k}": [rng.choice(["a", "b", "", f"u{i}", f"v{i}"]) for i in range(rng.randrange(40))] for k in range(60)}
    new = {k: sample(rng, v) for k, v in old.items()}
    new["only new"], old["only old"] = ["x", "y"], ["z"]
    texts = lambda docs: spark.createDataFrame([(k, "".join(f"{x}\n" for x in v)) for k, v in docs.items()], "k string, t string")
    got = {r.key: (r.added, r.removed) for r in align.line_counts(texts(old), texts(new), "k", "t").collect()}
    assert got == {k: (len(new.get(k, [])) - n, len(old.get(k, [])) - n) for k in {*old, *new} for n in [lcs(old.get(k, []), new.get(k, []))]}
    rows = align.changes(frame(spark, old), frame(spark, new), "k", "i", F.col("t")).collect()
    for k in {*old, *new}:
        mine = [r for r in rows if r.key == k]
        gone, come = {r.old_at for r in mine if r.old_at is not None}, {r.new_at for r in mine if r.new_at is not None}
        a, b = old.get(k, []), new.get(k, [])
        assert [x for i, x in enumerate(a) if i not in gone] == [x for i, x in enumerate(b) if i not in come]
        assert (len(come), len(gone)) == got[k]
        assert all((r.kind == "replace") == (r.old_at is not None and r.new_at is not None) for r in mine)


def test_odd_sequences(spark):
    cols = "k string, i int, t string"
    old = spark.createDataFrame([(None, 0, "x"), ("a", 5, None), ("a", 2, "p"), ("a", 9, "q"), ("e", 0, "same")], cols)
    new = spark.createDataFrame([("a", 1, "p"), ("a", 3, None), ("e", 7, "same"), ("n", 0, None)], cols)
    rows = sorted(tuple(r) for r in align.matches(old, new, "k", "i", F.col("t")).collect())
    assert rows == [("a", 0, 0, 2), ("e", 0, 0, 1)]
    assert sorted(tuple(r)[:2] for r in align.block_diff(old.where("k is not null"), new, "k", "t", "i", F.col("t")).collect()) == [("a", "delete"), ("n", "insert")]
    assert align.changes(old.where("false"), new.where("false"), "k", "i", F.col("t")).count() == 0


def text(lines: list[str]) -> str:
    return "".join(f"{x}\n" for x in lines)


def merge(spark, docs: list[tuple[list[str], list[str], list[str]]]) -> list[list[tuple[str, str]]]:
    side = lambda k: spark.createDataFrame([(str(i), text(d[k])) for i, d in enumerate(docs)], "k string, t string")
    rows = align.merged3(side(0), side(1), side(2), "k", "t").orderBy("key", "at").collect()
    return [[(r.line, r.origin) for r in rows if r.key == str(i)] for i in range(len(docs))]


def test_merge_laws(spark):
    rng = random.Random(8)
    bases = [[rng.choice(["a", "", f"u{i}", f"w{i}"]) for i in range(rng.randrange(25))] for _ in range(30)]
    edits = [sample(rng, b) for b in bases]
    others = [sample(rng, b) for b in bases]
    lines = lambda merged: [[x for x, _ in m] for m in merged]
    assert lines(merge(spark, [(b, b, e) for b, e in zip(bases, edits)])) == edits
    assert lines(merge(spark, [(b, e, b) for b, e in zip(bases, edits)])) == edits
    assert lines(merge(spark, [(b, e, e) for b, e in zip(bases, edits)])) == edits
    one, two = merge(spark, list(zip(bases, edits, others))), merge(spark, list(zip(bases, others, edits)))
    swap = {"ours": "theirs", "theirs": "ours", "conflict_ours": "conflict_theirs", "conflict_theirs": "conflict_ours"}
    for m, n in zip(one, two):
        assert sorted((x, swap.get(o, o)) for x, o in m) == sorted(n)


def test_merge_of_far_edits_and_a_conflict(spark):
    base = ["1", "2", "3", "4", "5", "6"]
    far, clash = merge(spark, [(base, ["0", *base[1:]], [*base[:5], "7", "8"]), (base, ["1", "x", *base[2:]], ["1", "y", *base[2:]])])
    assert far == [("0", "ours"), ("2", "base"), ("3", "base"), ("4", "base"), ("5", "base"), ("7", "theirs"), ("8", "theirs")]
    assert clash == [("1", "base"), ("x", "conflict_ours"), ("y", "conflict_theirs"), *[(x, "base") for x in base[2:]]]


@pytest.mark.parametrize(
    ("template", "built", "reviewed", "want"),
    [
        ("Power: |POWER| W", "Power: 300 W", "Power: 200 W", "Power: 300 W"),
        ("Power: |POWER| W", "Power: 300 W", "The power: 200 W", "The power: 200 W"),
        ("Power: |POWER| W", "Power: 300 W", "Power: 200 W", "Power: 300 W"),
        ("plain", "built", "reviewed", "reviewed"),
        ("|AA|", "text", ".. note::", ".. note::"),
        ("From |AA| to |B2|.", "From x to y.", "From 1 to 2.", "From x to y."), ("|AA| and |B2|", "x and y", "1 and 2", "1 and 2"),
        (".. note:: |AA|", ".. note:: new", ".. note:: old", ".. note:: new"),
    ],
)
def test_refreshed_lines(template, built, reviewed, want):
    assert align.refreshed_line(template, built, reviewed) == want


def test_refreshed_texts_keep_what_a_reviewer_wrote(spark):
    side = lambda **docs: spark.createDataFrame(list(docs.items()), "k string, t string")
    template = side(p="Title\n\nPower |WATTS| W\nMass |KG| kg\nEnd\n", q="|AA|\n")
    built = side(p="Title\n\nPower 300 W\nMass 9 kg\nEnd\n", q="one\n", fresh="all new\n")
    review = side(p="Title, edited\n\nPower 200 W\nA note\nA mass of 8 kg\nEnd", own="mine\n")
    got = {r.key: r.text for r in align.refreshed(template, built, review, "k", "t").collect()}
    assert got == {"p": "Title, edited\n\nPower 300 W\nA note\nA mass of 8 kg\nEnd", "q": "one\n", "fresh": "all new\n", "own": "mine\n"}


def test_no_row_a_text_is_broadcast_or_a_python_call(spark, tmp_path):
    """Texts of a small file are planned as small; what is joined by key and line must not go to the driver for that, and short texts share a batch."""
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("cast(id as string) as k", "concat('Title', chr(10), 'Name: |NAME|', chr(10), 'End ', id, chr(10)) as t").write.parquet(path)
    t = spark.read.parquet(path)
    built = t.withColumn("t", F.replace(F.col("t"), F.lit("|NAME|"), F.lit("new")))
    review = t.withColumn("t", F.concat(F.lit("Note\n"), F.replace(F.col("t"), F.lit("|NAME|"), F.lit("old"))))
    made = [align.refreshed(t, built, review, "k", "t"), align.merged3(t, built, review, "k", "t"), align.line_counts(t, built, "k", "t"), align.block_diff(*(x.select("k", F.posexplode(F.split("t", "\n")).alias("i", "t")) for x in (t, built)), "k", "t", "i", F.col("t"))]
    for df in made:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "FlatMapGroups" not in plan
    got = {r.key: r.text for r in made[0].collect()}
    assert got == {str(i): f"Note\nTitle\nName: new\nEnd {i}\n" for i in range(50)}
    assert made[1].where("origin = 'base'").groupBy("key").count().where("count = 2").count() == 50


def test_a_merge_is_a_row_a_key_until_its_lines_are_cut(spark, monkeypatch):
    """No join, window or aggregate of a row a line; texts above the bound, whose gaps are dealt, merge alike."""
    rng = random.Random(4)
    bases = [[rng.choice(["a", "b", "", f"u{i}"]) for i in range(n)] for n in (0, 1, 7, 20, 400)]
    docs = [(b, sample(rng, b), sample(rng, b)) for b in bases]
    docs.append(tuple([rng.choice("ab") for _ in range(300)] for _ in range(3)))  # a gap of more steps than are solved where it is found
    docs += [([], ["x"], []), (["x"], [], ["x", "y"]), ([], [], [])]
    side = lambda k: spark.createDataFrame([(str(i), text(d[k])) for i, d in enumerate(docs)] + [(None, ("p\nq\n", "p\nr\n", "P\nq\n")[k]), ("none", None)], "k string, t string")
    found = []
    for most in (None, 500, -1):
        if most is not None:
            monkeypatch.setattr(align, "_WHOLE", most)
        df = align.merged3(side(0), side(1), side(2), "k", "t")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and not [x for x in plan.splitlines() if "Join" in x and "at#" in x]
        found.append(sorted(map(tuple, df.collect()), key=str))
    assert found[0] == found[1] == found[2]
    assert [(x[2], x[3]) for x in found[0] if x[0] is None] == [("p", "conflict_ours"), ("r", "conflict_ours"), ("P", "conflict_theirs"), ("q", "conflict_theirs")]
    assert not [x for x in found[0] if x[0] == "none"]
    for i in range(len(docs)):
        assert sorted(x[1] for x in found[0] if x[0] == str(i)) == list(range(sum(x[0] == str(i) for x in found[0])))


def test_a_refreshed_text_is_a_row_a_key(spark, monkeypatch):
    """No join, window or aggregate of a row a line; texts above the bound, null keys and several reviews of a key."""
    lines = [f"Line {i}: |AA|" if i % 3 else f"same {i % 7}" for i in range(200)]
    fill = lambda x: [line.replace("|AA|", x) for line in lines]
    docs = [(lines, fill("new"), ["Note", *fill("old")]), (["|AA|"], ["new"], []), ([], ["new"], ["mine"]), (["A |BB|"], [], ["A 1"])]
    side = lambda k: [(str(i), text(d[k])) for i, d in enumerate(docs)] + [(None, ("|AA|\n", "new\n", "old\n")[k])]
    frame = lambda rows: spark.createDataFrame(rows, "k string, t string")
    for most in (None, 500, -1):
        if most is not None:
            monkeypatch.setattr(align, "_WHOLE", most)
        df = align.refreshed(frame([*side(0), ("null", "|AA|\n")]), frame([*side(1), ("null", "new\n"), ("fresh", "new\n")]), frame([*side(2), ("1", "old"), ("null", None)]), "k", "t")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and not [x for x in plan.splitlines() if "Join" in x and "at#" in x]
        want = [("0", text(["Note", *fill("new")])), ("1", ""), ("1", "new"), ("2", "mine\n"), ("3", "A 1\n"), (None, "old\n"), (None, "new\n"), ("null", None), ("fresh", "new\n")]
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
