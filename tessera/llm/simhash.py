"""SimHash near-duplicates: fingerprints, then a binary-trie self-join under a Hamming budget.

Fingerprints are made in Arrow batches (one pass over the text). Equal fingerprints are collapsed first, so a
large group of copies is one row. Pigeonhole keys deal the distinct fingerprints out: with a budget of d
differing bits, d + 2 bands cover the 64 bits and two linked fingerprints agree in two bands at least, so that every
pair of bands is a key. The fingerprints of a key are a trie; the self-join walks pairs of its nodes together,
adds up differing bits, and drops a pair as soon as the budget is exceeded. Keys of over `group_rows` are cut
into shards and every pair of shards is a group of its own, so no group is unbounded in one task. A group
returns a spanning forest of the links it found (at most one edge per fingerprint), never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, row_keys, written
from tessera.llm.components import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of a text's word shingles, repeats included, as an unsigned 64-bit number."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate(([0], ends[:-1]))
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):  # a very long text is hashed piece by piece
        spans = zip(begins[lo : lo + (1 << 16)].tolist(), (stops[lo : lo + (1 << 16)] - 1).tolist(), strict=False)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.left_shift(np.uint64(1), _SHIFTS)[2 * total > n]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(id, fp long, and the long columns `more`): the fingerprint's 64 bits as a signed long, one row per input row.
    Null text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t) for t in b.column(0).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], [*b.schema.names[1:], "fp"])

    asked = docs.select(F.col(text_col).cast("string").cast("binary").alias("t"), F.col(id_col).cast("long").alias("id"), *more)
    return arrow_map(asked, run, ", ".join(f"{c} long" for c in [*asked.columns[1:], "fp"]))


def _forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of (a, b) that join parts not joined before; label (a part's number by row) is brought up to date."""
    keep_a, keep_b = [], []
    while True:
        new = label[a] != label[b]
        a, b = a[new], b[new]
        if not len(a):
            break
        big, small = np.maximum(label[a], label[b]), np.minimum(label[a], label[b])
        _, first = np.unique(big, return_index=True)  # each part hangs on one smaller part
        keep_a.append(a[first])
        keep_b.append(b[first])
        to = np.arange(len(label))
        to[big[first]] = small[first]
        while not np.array_equal(nxt := to[to], to):
            to = nxt
        label[:] = to[label]
    return (np.concatenate(keep_a), np.concatenate(keep_b)) if keep_a else (np.zeros(0, np.int64),) * 2


def trie_pairs(
    x: np.ndarray, y: np.ndarray, roots: tuple[np.ndarray, ...], same: bool, budget: int, leaf: int = 1024, chunk: int = 1 << 19
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of x, j of y) whose uint64 values differ in at most budget bits.

    roots (xl, xh, yl, yh) are ranges of x and y, each sorted: the roots of as many pairs of binary tries, a
    node being a range that shares a prefix. Pairs of nodes are walked together bit by bit; the count of
    differing bits only grows, so a pair over the budget is dropped with all below it. Pairs of nodes of at
    most `leaf` combinations are compared directly. With same, x is y, roots pair with themselves, i < j.
    """
    stack = [(0, *roots, np.zeros(len(roots[0]), np.int64))]
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while stack:
        level, xl, xh, yl, yh, d = stack.pop()
        n = (xh - xl) * (yh - yl)
        done = (n <= leaf) | (level == 64)
        ends = np.cumsum(n[done])
        for lo, hi in _slices(ends, 4 * chunk):
            base = np.repeat(np.flatnonzero(done)[lo:hi], n[done][lo:hi])
            off = np.arange(len(base)) - np.repeat(ends[lo:hi] - n[done][lo:hi] - (ends[lo - 1] if lo else 0), n[done][lo:hi])
            wide = (yh - yl)[base]
            i, j = xl[base] + off // wide, yl[base] + off % wide
            near = (np.bitwise_count(x[i] ^ y[j]) <= budget) & ((i < j) | (not same))
            if near.any():
                yield i[near], j[near]
        xl, xh, yl, yh, d = (v[~done] for v in (xl, xh, yl, yh, d))
        if len(xl) > chunk:
            stack += [(level, *(v[k : k + chunk] for v in (xl, xh, yl, yh, d))) for k in range(0, len(xl), chunk)]
            continue
        if not len(xl):
            continue
        if level not in ones:
            count = lambda a: np.concatenate(([0], np.cumsum((a >> np.uint64(63 - level)) & np.uint64(1), dtype=np.int64)))  # noqa: B023, E731
            ones[level] = (count(x), count(y))
        ox, oy = ones[level]
        xm, ym = xh - (ox[xh] - ox[xl]), yh - (oy[yh] - oy[yl])  # where bit 0 ends and bit 1 begins
        mixed = (xl != yl) | (not same)  # a node paired with itself needs one of its two mixed pairs
        parts = [(xl, xm, yl, ym, d), (xm, xh, ym, yh, d), (xl, xm, ym, yh, d + 1), tuple(v[mixed] for v in (xm, xh, yl, ym, d + 1))]
        xl, xh, yl, yh, d = (np.concatenate(v) for v in zip(*parts, strict=True))
        live = (xh > xl) & (yh > yl) & (d <= budget)
        if live.any():
            stack.append((level + 1, *(v[live] for v in (xl, xh, yl, yh, d))))


def _slices(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cut items with running total ends into runs of about most in all."""
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _join_group(pdf: pd.DataFrame, budget: int) -> pd.DataFrame:
    """The links among one group's fingerprints, as a forest: within each key, or between its two sides."""
    key, side = pdf["key"].to_numpy(np.int64), pdf["side"].to_numpy()
    fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
    order = np.lexsort((fp, key, side))
    key, fp, cut = key[order], fp[order], int((side < 1).sum())
    same = not (side == 1).any()
    keys = np.unique(key[:cut])
    xl, xh = (np.searchsorted(key[:cut], keys, s) for s in ("left", "right"))
    yl, yh = (xl, xh) if same else (np.searchsorted(key[cut:], keys, s) for s in ("left", "right"))
    left, right = fp[:cut], fp[:cut] if same else fp[cut:]
    label, us, vs = np.arange(len(fp)), [], []
    for i, j in trie_pairs(left, right, (xl, xh, yl, yh), same, budget):
        a, b = _forest(i, j if same else j + cut, label)
        us.append(fp[a])
        vs.append(fp[b])
    u, v = (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.uint64),) * 2
    return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})


def band_keys(fp: Column, budget: int, spare: int = 2) -> list[Column]:
    """Keys of which two fingerprints within the budget share one at least.

    The 64 bits are cut into budget + spare bands. At most budget of them differ, so `spare` bands agree, and there
    is a key, tagged with its number, for every choice of that many bands. With a budget of 4 there are 15 keys of
    some 21 bits: 2^21 groups share the fingerprints, so that 5 x 10^10 of them make groups of about 24,000.
    """
    bands = budget + spare
    edge = [64 * k // bands for k in range(bands + 1)]
    band = [F.shiftrightunsigned(F.shiftleft(fp, 64 - edge[k + 1]), 64 - edge[k + 1] + edge[k]) for k in range(bands)]
    out = []
    for number, chosen in enumerate(combinations(range(bands), spare)):
        key = F.lit(number).cast("long")
        for k in chosen:
            key = F.shiftleft(key, edge[k + 1] - edge[k]).bitwiseOR(band[k])
        out.append(key)
    return out


def links(distinct: DataFrame, budget: int = 4, group_rows: int = 20_000) -> DataFrame:
    """(u, v) links that span every group of fingerprints chained by pairs within budget bits.

    distinct: one column fp long without repeats. Connects exactly what all pairs within the budget connect. A key's
    fingerprints that are more than group_rows are cut into shards, each pair of which is a group; keys of fewer
    share groups of about that size.
    """
    keyed = distinct.select("fp", F.explode(F.array(*band_keys(F.col("fp"), budget))).alias("key"))
    sizes = written(keyed.groupBy("key").count().where("count > 1"))
    held = sizes.agg(F.sum("count")).first()[0] or 0
    batch = F.pmod(F.xxhash64("key"), F.lit(-(-held // group_rows) or 1))
    placed = keyed.join(sizes, "key").withColumn("s", F.ceil(F.col("count") / F.lit(group_rows)).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), "s").cast("int"))
    dealt = placed.select("key", "fp", F.when(F.col("s") > 1, F.col("key")).alias("big"), F.when(F.col("s") == 1, batch).alias("batch"), "own", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("other"))
    dealt = dealt.select(
        "key", "fp", "big", "batch", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), -1).otherwise(1).alias("side"),
    )
    return dealt.groupBy("big", "batch", "i", "j").applyInPandas(lambda pdf: _join_group(pdf, budget), "u long, v long").distinct()


def _components(fps: DataFrame, budget: int) -> DataFrame:
    """(fp, root) for every distinct fp: the fingerprint that names its component."""
    distinct = written(fps.select("fp").distinct())
    roots = written(components(links(distinct, budget)))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id long, fp long, component_id long (the smallest id reachable, itself included).

    Empty and null texts have fingerprint zero and link like any other. Rows that repeat an id each get a row.
    Null ids take part and get a row; a component of null ids alone has a null component_id. Empty table: no rows.
    """
    fps = written(fingerprints(docs, id_col, text_col))
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    placed = _components(fps, budget).join(least, "fp")
    named = written(placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id"))
    return fps.join(named, "fp").select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one row of each near-duplicate group: that of the smallest id, nulls last.

    Of rows that share that id the one whose content has the least hash stays, and one of those that agree in all columns.
    Empty and null texts are one group. An empty table gives no rows.
    """
    h1, h2 = row_keys(*docs.columns)
    fps = written(fingerprints(docs, id_col, text_col, h1.alias("h1"), h2.alias("h2")))
    best = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h1", "h2")).alias("best"))
    keep = _components(fps, budget).join(best, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.h1", "best.h2")
    keyed = docs.select(F.struct("*").alias("row"), h1.alias("h1"), h2.alias("h2"))  # a struct: names of docs meet no key
    return keyed.join(keep, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select("row.*")
