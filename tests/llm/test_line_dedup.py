from __future__ import annotations

import random

from tessera.llm import line_dedup


def one_word_apart(a: list[str], b: list[str]) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows: list[tuple[int, str]], near_words: int) -> dict[int, tuple[str, int]]:
    lines = [(d, i, raw, raw.strip(" ")) for d, t in sorted(rows) for i, raw in enumerate(t.split("\n"))]
    first: dict[str, tuple[int, int]] = {}
    for d, i, _, s in lines:
        if s:
            first.setdefault(s, (d, i))
    near = set()
    words = {s: s.split(" ") for s in first}
    for s in first:
        if len(words[s]) >= near_words and any(first[o] < first[s] and len(words[o]) >= near_words and one_word_apart(words[s], words[o]) for o in first if o != s):
            near.add(s)
    out = {}
    for d, t in rows:
        own = [(i, raw) for dd, i, raw, s in lines if dd == d and (not s or (first[s] == (d, i) and s not in near))]
        out[d] = ("\n".join(r for _, r in own), len(t.split("\n")) - len(own))
    return out


def test_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(6)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(60)] + ["", "  "]
    rows = [(d, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for d in range(60)]
    got = {r.doc_id: (r.text, r.lines_removed) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), near_words=3).collect()}
    assert got == brute(rows, 3)


def test_edits_of_a_long_line(spark):
    base = [f"word{i}" for i in range(12)]
    swap, short, long = base[:5] + ["other"] + base[6:], base[:3] + base[4:], base[:7] + ["more"] + base[7:]
    far = base[:2] + ["x", "y"] + base[4:]
    rows = [(i, " ".join(w)) for i, w in enumerate([base, swap, short, long, far])]
    got = {r.doc_id: r.lines_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0}


def test_odd_rows(odd_docs, no_docs):
    found = line_dedup.dedup_lines(odd_docs)
    rows = found.collect()
    assert len(rows) == odd_docs.count() and found.columns[:5] == odd_docs.columns[:5]
    assert all(r.text is None for r in rows if r.doc_id == 3) and [r.text for r in rows if r.doc_id == 4] == [""]
    twins = [(r.text, r.lines_removed) for r in rows if r.doc_id == 1 and r.source == "a"]
    assert len(set(twins)) == 1
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_a_repeated_row_keeps_its_earliest_line(odd_docs):
    rows = line_dedup.dedup_lines(odd_docs).collect()
    line = next(r.text for r in odd_docs.where("doc_id = 1 and source = 'a'").collect())
    assert [(r.text, r.lines_removed) for r in rows if r.doc_id == 1 and r.source == "a"] == [(line, 0)] * 2
    assert [(r.text, r.lines_removed) for r in rows if r.doc_id == 2] == [("", 2)]


def test_clashing_columns_keep_their_values(odd_docs, clashing):
    clashing(line_dedup.dedup_lines(odd_docs), odd_docs, but=("lines_removed",))
