"""Removal of long repeated byte strings by enhanced suffix arrays over the places where a repeat can be.

Every window of `length` bytes is filed under the least hash of its k-grams; equal windows share it, so a
window whose least hash occurs nowhere else is unique. Runs of windows with one least k-gram are the pieces.
Only pieces whose hash occurs twice go on. Equal pieces are counted as one: their windows are all repeated.
Different pieces of one hash meet in a task that builds a suffix array over them, common-prefix lengths
between neighbours, and the interval tree of those lengths by a stack scan. A node of at least `length` whose
occurrences are preceded by different bytes is a maximal repeat group; its occurrences cover the windows.

Groups over `group_bytes` are not given to a task whole but dealt to shards. All pieces of a group hold its k-gram, so
two that share a window share o bytes before it and the other length - k - o after it. The shard of o in [lo, hi] is
named by the `lo` bytes before and the length - k - hi bytes after the k-gram, and pieces are cut to its windows; equal
cuts are counted as one again. A shard that is still too large is halved, down to a single o, where all is equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, row_keys, written
from tessera.llm.decontaminate import _range_hashes

_RANGES = "array<struct<s: int, e: int>>"


def pieces_of(data: bytes, length: int, k: int, block: int = 1 << 23) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, lo, hi): runs [lo, hi) of window starts whose least k-gram hash is one and the same k-gram.

    The last of equal hashes counts, so that equal windows have their least k-gram at the same offset.
    """
    n = len(data) - length + 1
    parts = []
    for first in range(0, n, block):  # a very long text goes block by block
        part = data[first : min(first + block, n) - 1 + length]
        m, wide = len(part) - length + 1, length - k + 1
        at = np.arange(len(part) - k + 1)
        hashes = _range_hashes(np.frombuffer(part, np.uint8).astype(np.uint64) + np.uint64(1), at, at + k)
        low = np.uint64((1 << 24) - 1)
        least = (hashes & ~low) | (low - at.astype(np.uint64))
        have = 1
        while 2 * have <= wide:
            least = np.minimum(least[: len(least) - have], least[have:])
            have *= 2
        least = np.minimum(least[:m], least[wide - have : wide - have + m])
        lo = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        parts.append((hashes[(low - (least[lo] & low)).astype(np.int64)], lo + first, np.append(lo[1:], m) + first))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class SuffixArray:
    """An enhanced suffix array over given starts of a byte string, by prefix doubling."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, room: np.ndarray, left: np.ndarray):
        """left: for every byte, how many bytes its text has from there on; room: the same for the starts."""
        n, depth, pad = len(data), int(room.max(initial=8)), np.zeros(4 * int(room.max(initial=8)) + 16, np.uint64)
        symbols = np.concatenate((data.astype(np.uint64) + np.uint64(1), pad))
        key, width = np.zeros(n, np.uint64), 7
        for j in range(width):  # seven symbols of nine bits; past the end of the text the symbol is 0
            key = (key << np.uint64(9)) | np.where(left > j, symbols[j : j + n], np.uint64(0))
        self.ranks = {}
        while True:
            order = np.argsort(key)  # equal keys share a rank, so their order does not matter
            short = (left < width)[order]  # a string that its text ends is like no other
            new = np.concatenate(([True], (key[order][1:] != key[order][:-1]) | short[1:] | short[:-1]))
            rank = np.zeros(n + len(pad), np.uint64)
            rank[order] = np.cumsum(new)
            self.ranks[width] = rank
            if 2 * width >= depth:
                break
            key = (rank[:n] << np.uint64(32)) | np.where(left > width, rank[width : width + n], np.uint64(0))
            width *= 2
        order = np.argsort((rank[starts] << np.uint64(32)) | rank[starts + width])
        self.starts, self.room = starts[order], room[order]
        a, b = self.starts[:-1], self.starts[1:]
        same, most = np.zeros(len(a), np.int64), np.minimum(self.room[:-1], self.room[1:])
        for w in (width, *sorted(self.ranks, reverse=True)):
            same += np.where((self.ranks[w][a + same] == self.ranks[w][b + same]) & (same < most), w, 0)
        going = np.ones(len(a), bool)
        for _ in range(7):
            going &= (same < most) & (symbols[a + same] == symbols[b + same])
            same += going
        self.lcp = same

    def intervals(self, least: int, before: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(lo, hi, length) of the nodes of the interval tree of at least `least` that are left-diverse.

        before: by rank, the byte before the suffix, or a number of its own where there is none.
        """
        changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1]))).tolist()
        lcp = np.where(self.lcp >= least, self.lcp, 0)
        ranks = np.flatnonzero(lcp)
        stack: list[tuple[int, int]] = []
        last = -2
        for r, height in zip(ranks.tolist(), lcp[ranks].tolist(), strict=True):
            if r != last + 1:
                while stack:
                    lo, h = stack.pop()
                    if changes[last + 1] != changes[lo]:
                        yield lo, last + 1, h
            lo = r
            while stack and stack[-1][1] >= height:
                lo, h = stack.pop()
                if h > height and changes[r] != changes[lo]:
                    yield lo, r, h
            stack.append((lo, height))
            last = r
        while stack:
            lo, h = stack.pop()
            if changes[last + 1] != changes[lo]:
                yield lo, last + 1, h


def repeat_groups(texts: list[bytes], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats among texts: (its length, all its occurrences as (text number, offset))."""
    array, text, offset, before = _array(texts, length)
    for lo, hi, h in array.intervals(length, before):
        yield h, list(zip(text[lo : hi + 1].tolist(), offset[lo : hi + 1].tolist(), strict=True))


def _array(texts: list[bytes], length: int) -> tuple[SuffixArray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(sizes) - sizes
    wins = np.maximum(0, sizes - length + 1)
    text = np.repeat(np.arange(len(texts)), wins)
    offset = np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins)
    data = np.frombuffer(b"".join(texts), np.uint8)
    left = np.repeat(base + sizes, sizes) - np.arange(len(data))
    array = SuffixArray(data, base[text] + offset, sizes[text] - offset, left)
    where = np.searchsorted(base, array.starts, "right") - 1
    while (empty := sizes[where] == 0).any():  # an empty text has the base of the next
        where = where - empty
    at = array.starts - base[where]
    before = np.where(at > 0, data[np.maximum(0, array.starts - 1)].astype(np.int64), 256 + where)
    return array, where, at, before


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which of its windows of `length` bytes start a string that another place starts too."""
    out = [np.zeros(max(0, len(t) - length + 1), bool) for t in texts]
    if not sum(map(len, out)):
        return out
    array, text, offset, before = _array(texts, length)
    longest = np.zeros(len(text), np.int64)
    for lo, hi, h in sorted(array.intervals(length, before), key=lambda x: x[2]):  # a node's children come after it
        longest[lo : hi + 1] = h
    base = np.cumsum([0, *map(len, out)])
    change = np.zeros(base[-1] + 1, np.int64)
    hit = longest > 0
    first = base[text[hit]] + offset[hit]
    np.add.at(change, first, 1)
    np.add.at(change, first + longest[hit] - length + 1, -1)
    covered = np.cumsum(change[:-1]) > 0
    return [covered[base[i] : base[i + 1]] for i in range(len(texts))]


def _runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8)))
    return [{"s": s, "e": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _heads(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(t1, t2, copies, a, lo, n): the pieces of each distinct text as arrays, and how many rows hold the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [pieces_of(x, length, k) for x in b.column(2).to_pylist()]
            a = pa.array([f[0].view(np.int64) for f in found], pa.list_(pa.int64()))
            lo = pa.array([f[1] for f in found], pa.list_(pa.int32()))
            n = pa.array([int(f[2][-1]) for f in found], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:2], a, lo, n], ["t1", "t2", "a", "lo", "n"])

    long = docs.where(F.length("b") >= length).select("t1", "t2", "b")
    heads = arrow_map(long, run, "t1 long, t2 long, a array<long>, lo array<int>, n int")
    return heads.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.first("a").alias("a"), F.first("lo").alias("lo"), F.first("n").alias("n"))


def _cut(texts: DataFrame, length: int, remembered: int = 200_000) -> DataFrame:
    """(t1, t2, lo, n, a, p1, p2, piece) for each piece named in texts (t1, t2, b, at array<struct<lo, hi, a>>).

    A task gives the bytes of a piece with its first occurrence and null with those that repeat it, as far as it
    remembers: it forgets all after `remembered` pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for t1, t2, data, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for i in range(0, len(at), 2000):
                    part = at[i : i + 2000]
                    cut = [data[x["lo"] : x["hi"] - 1 + length] for x in part]
                    names = [xxhash.xxh3_128_digest(p) for p in cut]
                    given = []
                    for name, p in zip(names, cut, strict=True):
                        given.append(None if name in seen else p)
                        seen.add(name)
                    if len(seen) > remembered:
                        seen.clear()
                    digest = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                    cols = [np.full(len(part), t1), np.full(len(part), t2), [x["lo"] for x in part], [x["hi"] - x["lo"] for x in part], [x["a"] for x in part], digest[:, 0], digest[:, 1]]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), pa.array(given, pa.binary())], ["t1", "t2", "lo", "n", "a", "p1", "p2", "piece"])

    return arrow_map(texts.select("t1", "t2", "b", "at"), run, "t1 long, t2 long, lo int, n int, a long, p1 long, p2 long, piece binary")


def _groups(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """The rows of whole groups, from rows sorted by their first column, as many groups at a time as make about most bytes."""
    rows: list[tuple] = []
    held = 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held >= most and row[0] != rows[-1][0]:
                yield rows
                rows, held = [], 0
            rows.append(row)
            held += len(row[-1])
    if rows:
        yield rows


def _compare(pieces: DataFrame, length: int, task_bytes: int) -> DataFrame:
    """(a, p1, p2, ranges): the repeated windows of pieces (g, a, p1, p2, start, piece), by suffix arrays over groups of
    one g. A piece begins at `start` of the one that a, p1, p2 name, and ranges count from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, task_bytes):
            _, a, p1, p2, start, piece = zip(*rows, strict=True)
            ranges = [[{"s": r["s"] + at, "e": r["e"] + at} for r in _runs(f)] for f, at in zip(repeated_windows(list(piece), length), start, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(ranges, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))], ["a", "p1", "p2", "ranges"])

    sorted_ = pieces.select("g", "a", "p1", "p2", "start", "piece").repartition("g").sortWithinPartitions("g")
    return arrow_map(sorted_, run, f"a long, p1 long, p2 long, ranges {_RANGES}")


def gram_place(piece: bytes, a: int, length: int, k: int) -> int:
    """Where in a piece its least k-gram begins, of hash a: in all its windows, the last such place of the first."""
    at = np.arange(len(piece) - length, length - k + 1)
    hashes = _range_hashes(np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1), at, at + k)
    return int(at[np.flatnonzero(hashes == np.uint64(a % (1 << 64)))[-1]])


def _halved(pieces: DataFrame, length: int, k: int) -> DataFrame:
    """Pieces (a, p1, p2, start, gram, lo, hi, piece) cut to both halves of [lo, hi], with the shard's key (g, g2) and the
    cut's own (d1, d2). gram: where the k-gram begins in the piece named by a, p1, p2; negative if not yet known."""
    ints, longs = ("start", "gram", "lo", "hi"), ("a", "p1", "p2", "g", "g2", "d1", "d2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in (*longs, *ints, "piece")}
            for a, p1, p2, start, gram, lo, hi, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                place = gram_place(piece, a, length, k) if gram < 0 else gram - start
                least, most, middle = place + length - len(piece), place, (lo + hi + 1) // 2  # the o that the piece has
                for first, last in ((lo, middle - 1), (middle, hi)):
                    low, high = max(first, least), min(last, most)
                    if low > high:
                        continue
                    shared = piece[place - first : place + length - last]
                    cut = piece[place - high : place - low + length]
                    g, g2 = np.frombuffer(xxhash.xxh3_128_digest(b"%d %d %d " % (a, first, last) + shared), np.int64).tolist()
                    d1, d2 = np.frombuffer(xxhash.xxh3_128_digest(cut), np.int64).tolist()
                    for c, v in zip(out, (a, p1, p2, g, g2, d1, d2, start + place - high, start + place, first, last, cut), strict=True):
                        out[c].append(v)
            kinds = [pa.int64()] * len(longs) + [pa.int32()] * len(ints) + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), kinds, strict=True)], list(out))

    asked = pieces.select("a", "p1", "p2", *ints, "piece")
    return arrow_map(asked, run, ", ".join([*(f"{c} long" for c in longs), *(f"{c} int" for c in ints), "piece binary"]))


def _compare_sharded(pieces: DataFrame, length: int, k: int, group_bytes: int, task_bytes: int) -> DataFrame:
    """As _compare, for groups of any size (a, p1, p2, piece), one row per piece: halves the shards of a group until they
    are of at most group_bytes; each halving is a pass over what is still too large, log2(length) passes at most."""
    found = []
    large = pieces.select("a", "p1", "p2", F.lit(0).alias("start"), F.lit(-1).alias("gram"), F.lit(0).alias("lo"), F.lit(length - k).alias("hi"), "piece")
    while True:
        cut = written(_halved(large, length, k))
        own = F.struct("a", "p1", "p2", "start", "gram", "lo", "hi")
        kinds = written(cut.groupBy("g", "g2", "d1", "d2").agg(F.count("*").alias("c"), F.min(own).alias("x"), F.first("piece").alias("piece")))
        again = cut.drop("piece").join(kinds.where("c > 1").select("g", "g2", "d1", "d2", F.length("piece").alias("bytes")), ["g", "g2", "d1", "d2"])
        found.append(again.select("a", "p1", "p2", F.array(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("bytes") - length + 1).alias("e"))).alias("ranges")))
        sizes = written(kinds.groupBy("g", "g2").agg(F.count("*").alias("n"), F.sum(F.length("piece")).alias("held")).where("n > 1"))
        different = lambda size: kinds.select("g", "g2", "x.*", "piece").join(sizes.where(size).select("g", "g2"), ["g", "g2"])  # noqa: B023, E731
        found.append(_compare(different(F.col("held") <= group_bytes), length, task_bytes))
        if sizes.where(F.col("held") > group_bytes).isEmpty():
            break
        large = different(F.col("held") > group_bytes).where("lo < hi")
    each = reduce(DataFrame.unionByName, [f.select("a", "p1", "p2", F.col("ranges").cast(_RANGES).alias("ranges")) for f in found])
    return each.where("size(ranges) > 0").groupBy("a", "p1", "p2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def repeated_spans(docs: DataFrame, length: int, k: int, group_bytes: int, task_bytes: int) -> DataFrame:
    """(t1, t2, starts array<struct<s, e>>): the ranges of window starts of each distinct text that repeat.

    docs: (b binary, t1, t2), b not null and t1, t2 its keys.
    """
    heads = written(_heads(docs, length, k))
    ends = F.concat(F.slice("lo", 2, F.greatest(F.size("lo") - 1, F.lit(0))), F.array("n"))
    each = heads.select("t1", "t2", F.explode(F.arrays_zip(F.col("a"), F.col("lo"), ends.alias("hi"))).alias("x")).select("t1", "t2", "x.a", "x.lo", "x.hi")
    again = written(each.groupBy("a").count().where("count > 1").select("a"))  # a table of its own, so that a join partition with a frequent a can be split
    at = each.join(again, "a", "left_semi").groupBy("t1", "t2").agg(F.collect_list(F.struct("lo", "hi", "a")).alias("at"))
    texts = docs.select("t1", "t2", "b").join(at, ["t1", "t2"]).dropDuplicates(["t1", "t2"])
    pieces = written(_cut(texts, length))

    counted = written(pieces.groupBy("a", "p1", "p2").agg(F.count("*").alias("c"), F.first("piece", ignorenulls=True).alias("piece")))
    mixed = written(counted.groupBy("a").agg(F.count("*").alias("kinds"), F.sum(F.length("piece")).alias("held")).where("kinds > 1"))
    distinct = lambda size: counted.join(mixed.where(size), "a").select("a", "p1", "p2", "piece")
    found = _compare(distinct(F.col("held") <= group_bytes).select(F.col("a").alias("g"), "a", "p1", "p2", F.lit(0).alias("start"), "piece"), length, task_bytes)
    if not mixed.where(F.col("held") > group_bytes).isEmpty():
        found = found.unionByName(_compare_sharded(distinct(F.col("held") > group_bytes), length, k, group_bytes, task_bytes))
    verdicts = written(counted.join(found, ["a", "p1", "p2"], "left").where("c > 1 or size(ranges) > 0").select("a", "p1", "p2", "c", "ranges"))  # its own table too: a very frequent piece's partition can be split
    own = pieces.select("t1", "t2", "lo", "n", "a", "p1", "p2").join(verdicts, ["a", "p1", "p2"])
    whole = F.array(F.struct(F.col("lo").alias("s"), (F.col("lo") + F.col("n")).alias("e")))
    moved = F.transform("ranges", lambda r: F.struct((r["s"] + F.col("lo")).alias("s"), (r["e"] + F.col("lo")).alias("e")))
    starts = own.select("t1", "t2", F.explode(F.when(F.col("c") > 1, whole).otherwise(moved)).alias("r")).groupBy("t1", "t2").agg(F.collect_list("r").alias("starts"))
    copied = heads.where("copies > 1").select("t1", "t2", F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e"))).alias("all"))
    joined = starts.join(copied, ["t1", "t2"], "full")
    return joined.select("t1", "t2", F.coalesce("all", "starts").alias("starts"))


def remove_repeats(docs: DataFrame, length: int = 200, k: int = 32, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 1 << 20, task_bytes: int = 1 << 18) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans, kept_sha256), one row per row of docs.

    A byte goes if a `length`-byte string that covers it starts anywhere else too, in the same row or another;
    rows that repeat a text are elsewhere for each other. Null text counts as empty; texts shorter than `length`
    stay whole; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t1, t2 = row_keys(text)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("b"), t1.alias("t1"), t2.alias("t2"))
    spans = written(repeated_spans(keyed, length, k, group_bytes, task_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, data, starts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                change = np.zeros(len(data) + 1, np.int64)
                for r in starts or ():
                    change[r["s"]] += 1
                    change[r["e"] - 1 + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((doc_id, kept, len(data), int(gone.sum()), len(_runs(gone)), hashlib.sha256(kept).hexdigest()))
            if out:
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = keyed.join(spans, ["t1", "t2"], "left").select("doc_id", "b", "starts")
    return arrow_map(joined, run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
