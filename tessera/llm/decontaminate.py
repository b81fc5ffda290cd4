"""Benchmark decontamination by winnowing.

Every text is read as words; a word k-gram's hash is kept where it is the least of its sliding window, the
window being wide enough that any `span` consecutive words hold one kept hash. Kept hashes of documents are
matched with those of the benchmark, every match is extended to the windows of `span` words around it, and
these join the benchmark's windows as text, so that no hash decides alone. Benchmark items shorter than
`span` are windows of their own length: the hashes of all document k-grams of such a length are matched.

The benchmark is the stated query set. Its kept hashes go to the tasks as a sorted array if they are counted to be at
most `sent_hashes` (8 MB); the hashes of a larger benchmark meet those of the documents in a join, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, row_keys, written

#: A byte of a word (non-ASCII, digit, letter), lower-cased; everything else parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def folded(text: bytes | None) -> bytes:
    return (text or b"").translate(_FOLD)


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(cache.get("p", ())) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("p", _MULT), ("q", np.uint64(pow(int(_MULT), -1, 1 << 64)))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                cache[name] = np.multiply.accumulate(a)
    return cache["p"][:n], cache["q"][:n]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of bytes other than a space."""
    a = np.frombuffer(data, np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], a, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(27))


def _range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of values[lo:hi] for each range, from running sums: its cost does not depend on the lengths."""
    with np.errstate(over="ignore"):
        p, q = _powers(len(values) + 1)
        run = np.concatenate(([np.uint64(0)], np.cumsum(values * p[1 : len(values) + 1], dtype=np.uint64)))
        return _mixed((run[hi] - run[lo]) * q[lo] + (hi - lo).astype(np.uint64) * _MIX)


def gram_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    n = len(starts) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    words = _range_hashes(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), starts, ends)
    at = np.arange(n)
    return _range_hashes(words, at, at + k)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the least hash of each run of `window`, the last of equals; all runs if fewer give one."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    least = hashes[: len(hashes) - window + 1].copy()
    for j in range(1, window):
        np.minimum(least, hashes[j : j + len(least)], out=least)
    best = np.zeros(len(least), np.int64)
    for j in range(window):  # the last position that has the least hash
        best = np.where(hashes[j : j + len(least)] == least, j, best)
    return np.unique(best + np.arange(len(least)))


def windows_of(items: DataFrame, span: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, n, w, hashes): the distinct windows of each item as text, with the k-gram hashes kept in it."""
    k = max(1, span // 2 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = folded(text)
                starts, ends = word_spans(data)
                n = min(span, len(starts))
                if not n:
                    continue
                words = data.split()
                if n < span:
                    out.append((item, n, _text(b" ".join(words)), gram_hashes(data, starts, ends, n).view(np.int64).tolist()))
                    continue
                hashes = gram_hashes(data, starts, ends, k)
                for s in range(len(words) - span + 1):
                    part = hashes[s : s + span - k + 1]
                    out.append((item, n, _text(b" ".join(words[s : s + span])), part[winnow(part, span - k + 1)].view(np.int64).tolist()))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64())), strict=True)], ["item_id", "n", "w", "hashes"])

    source = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return arrow_map(source, run, "item_id long, n int, w string, hashes array<long>").distinct()


def _kept(data: bytes, starts: np.ndarray, ends: np.ndarray, n: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) by which windows of n words are looked up: winnowed k-grams for n = span, else all n-grams."""
    k = max(1, span // 2 - 1)
    hashes = gram_hashes(data, starts, ends, k if n == span else n)
    if len(starts) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = winnow(hashes, span - k + 1) if n == span else np.arange(len(hashes))
    return at, hashes[at]


def _around(data: bytes, starts: np.ndarray, ends: np.ndarray, n: int, at: np.ndarray, span: int) -> list[dict]:
    """The windows of n words that hold one of the k-grams at `at`, with their text."""
    if n == span and len(at):
        at = np.unique((at[:, None] - np.arange(span - max(1, span // 2 - 1) + 1)[None, :]).ravel())
        at = at[(at >= 0) & (at <= len(starts) - span)]
    return [{"s": s, "n": n, "w": _text(re.sub(rb" +", b" ", data[a:e]))} for s, a, e in zip(at.tolist(), starts[at].tolist(), ends[at + n - 1].tolist(), strict=True)]


def _text(words: bytes) -> str:
    """Words as a string; bytes that are no UTF-8 become replacement characters, on both sides alike."""
    return words.decode(errors="replace")


_HITS = pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int32()), ("w", pa.string())]))
_KEYS = "doc_id long, k1 long, k2 long"


def _candidates(docs: DataFrame, known: dict[int, np.ndarray], span: int) -> DataFrame:
    """(doc_id, k1, k2, n_words, hits array<struct<s, n, w>>): windows of docs around each kept hash that is known.

    known: by window length, the sorted hashes of the benchmark's windows of that length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, found = [], []
            for text in b.column(3).to_pylist():
                data = folded(text)
                starts, ends = word_spans(data)
                counts.append(len(starts))
                hits = []
                for n, hashes in known.items():
                    at, own = _kept(data, starts, ends, n, span)
                    if len(at) and len(hashes):
                        hits += _around(data, starts, ends, n, at[hashes[np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)] == own], span)
                found.append(hits)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(counts, pa.int64()), pa.array(found, _HITS)], ["doc_id", "k1", "k2", "n_words", "hits"])

    return arrow_map(docs.select("doc_id", "k1", "k2", F.col("text").cast("binary")), run, f"{_KEYS}, n_words long, hits array<struct<s: long, n: int, w: string>>")


def _joined_candidates(docs: DataFrame, hashes: DataFrame, lengths: list[int], span: int) -> DataFrame:
    """As _candidates, for a benchmark of any size: kept hashes of docs meet those of the benchmark (n, h) in a join."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("n", pa.int32()), ("s", pa.int64()), ("h", pa.int64())]))
        for b in batches:
            counts, found = [], []
            for text in b.column(3).to_pylist():
                data = folded(text)
                starts, ends = word_spans(data)
                counts.append(len(starts))
                found.append([{"n": n, "s": s, "h": h} for n in lengths for s, h in zip(*(x.tolist() for x in (lambda at, own: (at, own.view(np.int64)))(*_kept(data, starts, ends, n, span))), strict=True)])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(counts, pa.int64()), pa.array(found, shape)], ["doc_id", "k1", "k2", "n_words", "kept"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for text, places in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                data, hits = folded(text), []
                starts, ends = word_spans(data)
                for n in sorted({p["n"] for p in places or ()}):
                    hits += _around(data, starts, ends, n, np.array(sorted({p["s"] for p in places if p["n"] == n})), span)
                found.append(hits)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(found, _HITS)], ["doc_id", "k1", "k2", "n_words", "hits"])

    source = docs.select("doc_id", "k1", "k2", F.col("text").cast("binary").alias("text"))
    scanned = written(arrow_map(source, kept, f"{_KEYS}, n_words long, kept array<struct<n: int, s: long, h: long>>"))
    places = scanned.select("k1", "k2", F.explode("kept").alias("x")).select("k1", "k2", "x.n", "x.s", "x.h").join(hashes, ["n", "h"])
    listed = places.groupBy("k1", "k2").agg(F.collect_set(F.struct("n", "s")).alias("places"))  # as long as a text has words
    counted = scanned.select("k1", "k2", "n_words").dropDuplicates(["k1", "k2"])
    asked = source.join(counted, ["k1", "k2"]).join(listed, ["k1", "k2"], "left").select("doc_id", "k1", "k2", "n_words", "text", "places")
    return arrow_map(asked, windows, f"{_KEYS}, n_words long, hits array<struct<s: long, n: int, w: string>>")


def _matched(docs: DataFrame, benchmark: DataFrame, span: int, id_col: str, text_col: str, sent_hashes: int) -> tuple[DataFrame, DataFrame]:
    """(scanned, matched): (doc_id, k1, k2, n_words) by row, and (k1, k2, s, n, item_id) by occurrence of a window."""
    k1, k2 = row_keys(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), k1.alias("k1"), k2.alias("k2"))
    windows = written(windows_of(benchmark, span, "item_id", "text"))
    hashes = written(windows.select("n", F.explode("hashes").alias("h")).distinct())
    if hashes.count() <= sent_hashes:
        n, h = (hashes.toArrow().column(c).to_numpy() for c in ("n", "h"))
        hits = _candidates(keyed, {int(v): np.sort(h[n == v].view(np.uint64)) for v in np.unique(n)}, span)
    else:
        hits = _joined_candidates(keyed, hashes, sorted(r["n"] for r in hashes.select("n").distinct().collect()), span)  # lengths up to span
    scanned = written(hits)
    spans = scanned.where(F.size("hits") > 0).select("k1", "k2", F.explode("hits").alias("x")).select("k1", "k2", "x.s", "x.n", "x.w").distinct()
    matched = written(spans.join(windows.select("item_id", "n", "w"), ["n", "w"]).select("k1", "k2", "s", "n", "item_id"))
    return scanned.select("doc_id", "k1", "k2", "n_words"), matched


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text", sent_hashes: int = 1 << 20) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is `span` consecutive words of an item, or the whole of a shorter item. A document word inside any
    occurrence of a window is hit. Null and empty texts have no words and no hits; rows that repeat an id each
    get a row, and those that agree in id and text the same one; an empty benchmark hits nothing.
    """
    scanned, matched = _matched(docs, benchmark, span, id_col, text_col, sent_hashes)
    upto = W.partitionBy("k1", "k2").orderBy("s", "n").rowsBetween(W.unboundedPreceding, -1)
    runs = matched.select("k1", "k2", "s", "n").distinct().withColumn("till", F.coalesce(F.max(F.col("s") + F.col("n")).over(upto), F.lit(0)))
    covered = runs.groupBy("k1", "k2").agg(F.sum(F.greatest(F.lit(0), F.col("s") + F.col("n") - F.greatest("s", "till"))).alias("n_hit"))
    listed = matched.select("k1", "k2", "item_id").distinct().groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    rows = scanned.join(covered, ["k1", "k2"], "left").join(listed, ["k1", "k2"], "left")
    items: Column = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, span: int = 10, id_col: str = "doc_id", text_col: str = "text", sent_hashes: int = 1 << 20) -> DataFrame:
    """The rows of docs, all columns, in which no window of the benchmark occurs.

    Null and empty texts stay. Rows that repeat stay or go together. An empty benchmark takes nothing; an empty table
    gives no rows.
    """
    _, matched = _matched(docs, benchmark, span, id_col, text_col, sent_hashes)
    k1, k2 = row_keys(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    keyed = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2"))  # a struct: names of docs meet no key
    return keyed.join(matched.select("k1", "k2").distinct(), ["k1", "k2"], "left_anti").select("row.*")
