from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import vector_codes


def brute(rows: list[tuple], parts: int, entries: int, rounds: int, scale: int = 1024) -> tuple[dict, str]:
    """rows (id, vector, label) with different ids; plain Python integers throughout."""
    whole = sorted((i, [int(x) * scale if abs(x) >= 2**53 else int(np.floor(x * scale)) for x in v], label) for i, v, label in rows)
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in whole[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held: dict[int, list] = {}
            for _, v, _ in whole:
                held.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(books[p])]
    out = {}
    for i, v, label in whole:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label)
    text = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, parts, entries, rounds):
    want, digest = brute(rows, parts, entries, rounds)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = vector_codes.digests(df, parts=parts, entries=entries, rounds=rounds).collect()
    fits = lambda e: e if e < 1 << 63 else None
    assert {r.vec_id: (r.code, r.error) for r in got} == {i: (c, fits(e)) for i, (c, e, _) in want.items()}
    sums: dict = {}
    for _, e, label in want.values():
        sums[label] = sums.get(label, 0) + e
    lost = {label for _, e, label in want.values() if fits(e) is None}
    assert all(r.label_error == (None if want[r.vec_id][2] in lost else fits(sums[want[r.vec_id][2]])) for r in got)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_brute_force_with_ties_and_unused_entries(spark):
    rng = random.Random(3)
    rows = [(i * 3, [float(rng.randint(-2, 2)) / 1024 for _ in range(8)], rng.choice([None, 1, 2])) for i in range(120)]
    check(spark, rows, 4, 16, 3)
    rows = [(i, [rng.gauss(0, 1) * (5 if i % 7 else 100) for _ in range(24)], i % 3) for i in range(90)]
    check(spark, rows, 4, 256, 2)


def test_components_of_any_size(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([0, 0, 0, 6, 20, 306]) for _ in range(8)], i % 2) for i in range(40)]
    rows += [(100 + i, [rng.gauss(0, 1) for _ in range(8)], 5) for i in range(20)]
    check(spark, rows, 2, 8, 2)
    check(spark, [(i, [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(30)] + [(99, [1e308, -1e308, 5e-324, -5e-324, 0.0, -0.0, 1e16, -1e16], 1)], 4, 8, 2)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 40), st.integers(1, 20), st.sampled_from([1, 2, 3, 5, 8, 16]), st.sampled_from([1, 3, 1000, 1 << 24]), st.booleans())
def test_bounds_keep_the_nearest(seed, n, k, width, spread, far):
    rng = np.random.default_rng(seed)
    x, e = rng.integers(-spread, spread + 1, (n, width)), rng.integers(-spread, spread + 1, (k, width))
    if far:
        x, e = x + (1 << 24) - 1 - spread, e + (1 << 24) - 1 - spread
    code, dist = vector_codes.Codebook(e).nearest(x)
    d = ((x[:, None, :] - e[None, :, :]) ** 2).sum(axis=2)
    assert code.tolist() == d.argmin(axis=1).tolist() and dist.tolist() == d.min(axis=1).tolist()


def test_bounds_leave_few_entries_to_measure():
    rng = np.random.default_rng(1)
    base = np.cumsum(rng.normal(0, 100, (300, 16)), axis=1).astype(np.int64)
    book = vector_codes.Codebook(base[:256])
    book.nearest(base + rng.integers(-5, 6, base.shape))
    assert book.measured < 300 * 256 * 0.1


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [float(i), 1.0, 2.0, 3.0], 1) for i in range(5)]
    odd = [(10, None, 1), (11, [1.0, None, 2.0, 3.0], 1), (12, [1.0, nan, 2.0, 3.0], 1), (13, [inf, 1.0, 2.0, 3.0], 1), (14, [], 1), (15, [1.0, 2.0], 1), (16, [1.0] * 6, 1)]
    twice = [(2, [9.0, 1.0, 2.0, 3.0], None), (None, [4.0, 4.0, 4.0, 4.0], None), (None, [4.0, 4.0, 4.0, 4.0], None)]
    df = spark.createDataFrame(good + odd + twice, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' as id", "'y' as v", "'z' as codes", "1 as error", "2 as l", "3 as n")
    rows = vector_codes.digests(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in rows) == sorted([(False, i) for i in (0, 1, 2, 2, 3, 4)] + [(True, 0)] * 2)
    assert all(r.error == 0 for r in rows if r.vec_id in (0, 1, 3, 4)) and [r.code for r in rows if r.vec_id == 4] == ["05000000"]  # the far twin of id 2 draws entry 4 away
    assert len({r.label_error for r in rows if r.vec_id is None}) == 1
    assert vector_codes.digests(df.where("false")).count() == 0 and vector_codes.digests(df.where("vec_id >= 10")).count() == 0
    coded, books = vector_codes.compress(df.where("vec_id < 5"))
    values = vector_codes.decoded(coded.where("error = 0").orderBy("id").toPandas()["codes"], books)
    assert values.tolist()[0] == [0, 1024, 2048, 3072]
    with pytest.raises(ValueError):
        vector_codes.compress(df, entries=257)
