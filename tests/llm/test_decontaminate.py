from __future__ import annotations

import hashlib
import random
import re

from tessera.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs: list[tuple], items: list[tuple], span: int) -> list[tuple]:
    wins = []
    for item, t in items:
        w = words(t)
        n = min(span, len(w))
        wins += [(item, w[i : i + n]) for i in range(len(w) - n + 1)] if n else []
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for item, g in wins:
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(item))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_brute_force(spark):
    rng = random.Random(3)
    vocab = ["a", "b", "C", "ä", "9"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "-", "  ", ", "]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 6, 9]))) for i in range(12)] + [(99, None)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(5, "a b"), (None, text(30)), (41, None)]
    for sent in (1 << 20, 7):
        got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), span=5, sent_hashes=sent)
        rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()), key=str)
        assert rows == brute(docs, items, 5)


def test_winnowing_keeps_one_of_every_window():
    import numpy as np

    h = np.random.default_rng(1).integers(0, 50, 300, dtype=np.uint64)
    kept = set(decontaminate.winnow(h, 7).tolist())
    assert all(kept & set(range(i, i + 7)) for i in range(len(h) - 6))


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, "")], "item_id long, text string")
    rows = decontaminate.contamination(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    assert {r.contaminated for r in rows if r.doc_id == 2} == {True} and not any(r.contaminated for r in rows if r.doc_id in (3, 4, 5, 8))
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd_docs, bench.where("false")).collect())
    assert decontaminate.decontaminated(odd_docs, bench).columns == odd_docs.columns


def test_clashing_columns_keep_their_values(spark, odd_docs, clashing):
    items = spark.createDataFrame([(1, "some other words that no document of these has in it at all")], "item_id long, text string")
    clashing(decontaminate.decontaminated(odd_docs, items), odd_docs)
