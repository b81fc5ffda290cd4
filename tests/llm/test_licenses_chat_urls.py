from __future__ import annotations

import os
import random
import re

from tessera.llm import chat, licenses, urls


def plain_scan(text: str | None, templates: dict[str, tuple[str, ...]], least: float = 0.8) -> list[tuple]:
    """Every window of every template by definition, then those that no better one overlaps."""
    words = re.findall("[a-z0-9]+", (text or "").lower())
    pairs = lambda w: {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
    found = set()
    for name, texts in templates.items():
        for t in texts:
            own = re.findall("[a-z0-9]+", t.lower())
            m = min(len(own), len(words))
            for s in range(len(words) - m + 1) if m > 1 else ():
                held = pairs(words[s : s + m])
                dice = 2 * len(held & pairs(own)) / (len(held) + len(pairs(own)))
                if dice >= least:
                    found.add((-dice, -m, name, s))
    rank = sorted(found)
    return sorted((s, -m, n, -d) for i, (d, m, n, s) in enumerate(rank) if not any(o[3] < s - m and s < o[3] - o[1] for o in rank[:i]))


def test_licences(spark, odd_docs, no_docs):
    rows = [(1, "Intro.\nReleased under the MIT License.\nMore"), (2, "released UNDER the mit license"), (3, "Licensed under the Apache License, Version 2.0"), (4, None), (5, ""), (6, "mit"), (7, "a text about the release of a license under which nothing is")]
    rows += [(None, "It is\nreleased under\nthe MIT License. Twice: Released under the MIT License."), (7, "Released under the MIT License."), (7, "Released under the MIT License.")]
    got = sorted(((r.doc_id, r.line_no, r.word, r.license, round(r.dice, 3)) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want = [(1, 1, 1, "MIT", 1.0), (2, 0, 0, "MIT", 1.0), (3, 0, 0, "Apache-2.0", 1.0), (None, 1, 2, "MIT", 1.0), (None, 2, 8, "MIT", 1.0), (7, 0, 0, "MIT", 1.0), (7, 0, 0, "MIT", 1.0)]
    assert got == sorted(want, key=str)
    assert licenses.scan(odd_docs).count() == 0 and licenses.scan(no_docs).count() == 0


def test_licence_texts_inside_longer_documents(spark):
    """Full texts and headers wrapped at odd places, with words before and after, and with a few words changed."""
    rng = random.Random(8)
    filler = lambda n: " ".join(rng.choice(["ratio", "and", "the", "file", "of", "lorem", "ipsum", "use"]) for _ in range(n))
    asked = [("MIT", 2), ("BSD-3-Clause", 2), ("BSD-2-Clause", 2), ("Apache-2.0", 3), ("GPL-3.0", 1), ("Zlib", 0), ("ISC", 2), ("MPL-2.0", 1)]
    rows = []
    for i, (name, which) in enumerate(asked):
        words = licenses.TEMPLATES[name][which].split()
        if i % 2:
            words[len(words) // 2] = "changed"
        lines = [" ".join(words[j : j + 11]) for j in range(0, len(words), 11)]
        rows.append((i, f"{filler(40)}\n{filler(9)} " + "\n * ".join(lines) + f" {filler(30)}\n{filler(5)}"))
    got = {r.doc_id: (r.license, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in enumerate(asked)} and min(d for _, d in got.values()) > 0.9


def test_windows_brute_force(spark):
    templates = {"A": ("a b c d e f",), "B": ("a b c d e g", "x y z")}
    rng = random.Random(1)
    texts = ["a b c d e f", "a b c d e", "b c d e f a b c d", "x y", "a b a b a b c d e f", "x y z x y z a b c d e g", *(" ".join(rng.choice("abcdefgxyz") if rng.random() < 0.3 else w for w in ("a b c d e f x y z " * 4).split()) for _ in range(40))]
    got: dict[int, list] = {i: [] for i in range(len(texts))}
    for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates).collect():
        got[r.doc_id].append((r.word, r.n_words, r.license, r.dice))
    assert {i: sorted(v) for i, v in got.items()} == {i: plain_scan(t, templates) for i, t in enumerate(texts)}


def test_preferences(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", None), (2, 0, "user", "x"), (2, 1, "assistant", "y"), (3, 0, "user", "x"), (4, 0, "user", "alone"), (None, 0, "user", "lost"), (5, None, "user", "lost"), (0, 1, "assistant", "yes")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in chat.preferences(turns, chat.paired_by_id(turns)).collect()}
    a, b = got[0], got[1]
    assert (a.prompt_turns, a.prompt, a.chosen, a.rejected) == (1, "<|user|>\nhi\n", "<|assistant|>\nyes\n", "<|assistant|>\nno\n<|user|>\n\n")
    lo, hi = map(int, a.chosen_mask.split("-"))
    assert a.chosen[lo:hi] == "yes"
    assert (b.prompt_turns, b.chosen, b.rejected, b.rejected_mask) == (1, "<|assistant|>\ny\n", "", "")
    assert chat.preferences(turns.where("false"), chat.paired_by_id(turns.where("false"))).count() == 0


def test_urls(spark):
    seen = ["http://EXAMPLE.com/en/x?q", "https://www.example.com/en/", "ftp://a.b.net/es/#f", "http://net/fr/", "http://fr.net/fr", "nothing", None, "x://", "http://com.org/", "http://example.com?x://com/", "http://notexample.com/en/", "://com/"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.verdicts(spark.createDataFrame(list(enumerate(seen)), "page_id long, url string")).collect()}
    assert got == {
        0: ("example.com", "/en/x", "example.com/en/", "block"), 1: ("www.example.com", "/en/", "www.example.com/en/", "allow"), 2: ("a.b.net", "/es/", "net/es/", "block"), 3: ("net", "/fr/", "net/fr/", "block"),
        4: ("fr.net", "/fr", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("com.org", "/", None, "allow"), 9: ("example.com", "", None, "allow"),
        10: ("notexample.com", "/en/", "com/", "allow"), 11: ("com", "/", "com/", "allow"),
    }


def test_rules_as_a_table_agree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    assert urls.verdicts(pages).exceptAll(urls.joined_verdicts(pages, rules)).count() == 0
    assert urls.verdicts(pages.where("false")).count() == 0


def test_a_key_alone_never_decides(tmp_path):
    path = os.fspath(tmp_path / "r.bin")
    with open(path, "wb") as f:
        f.write(urls.DigestArray.layout([("a.com", "/", "block"), ("b.com", "/", "allow")]))
    array = urls.DigestArray(path)
    array.keys = array.keys.copy()
    array.keys[:] = array.keys[0]  # as if both texts had one key
    import xxhash

    for t in (b"a.com/", b"b.com/"):
        if xxhash.xxh64_intdigest(t) == int(array.keys[0]):
            assert array.find([t, b"zzz"]) == ["block" if t[:1] == b"a" else "allow", None]
