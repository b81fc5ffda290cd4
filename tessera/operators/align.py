"""Alignment of two versions of a sequence (lines, blocks) by a minimal edit script, and three-way merges by it.

Entries that only one side has can match nothing and are left out first. What is unique on both sides is an anchor; the longest
increasing run of anchors, extended over equal neighbours, is an alignment and so an upper bound D on the edits needed. A stretch of
equal entries with more than D / 2 unique ones lies on some minimal script: a script past it would have to delete and to
insert them all. So such stretches cut a document into pieces that are minimal each on their own, every piece with a
bound of its own, until nothing cuts any more. A piece whose alignment meets the lower bound (entries less common ones) is done; the
others are gaps, rows of their own that are dealt to all tasks and solved exactly by bit-parallel longest common subsequences.

Only a document's hashes (8 bytes an entry) meet in one task, for the anchors, in linear memory; gaps take n m / 64 steps. A three-way merge
and a refresh bring the three texts of a key together in one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

Run = tuple[int, int, int]  # start in the old side, start in the new side, length


def _zeros(rows: list, cols: list) -> np.ndarray:
    """Length of the longest common subsequence of rows with each prefix of cols, the empty one first.

    The last row of the table as a bit vector, a zero for each step up, moved on row by row with whole-number arithmetic.
    """
    size = len(cols)
    where: dict = {}
    for i, c in enumerate(cols):
        where.setdefault(c, []).append(i)
    masks: dict = {}
    full = (1 << size) - 1
    v = full
    for r in rows:
        if (at := where.get(r)) is None:
            continue
        mask = masks.get(r)
        if mask is None:
            bits = np.zeros(size, np.uint8)
            bits[at] = 1
            mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            if len(masks) < 256 or size < 4096:
                masks[r] = mask
        up = v & mask
        v = ((v + up) | (v - up)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little")[:size]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def common_runs(a: list, b: list) -> list[Run]:
    """The matches of one longest common subsequence, as runs; by halves, in memory linear in the lengths."""
    out: list[Run] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i0, i1, j0, j1 = stack.pop()
        s = 0
        while i0 + s < i1 and j0 + s < j1 and a[i0 + s] == b[j0 + s]:
            s += 1
        if s:
            out.append((i0, j0, s))
            i0, j0 = i0 + s, j0 + s
        s = 0
        while i1 - s > i0 and j1 - s > j0 and a[i1 - s - 1] == b[j1 - s - 1]:
            s += 1
        if s:
            out.append((i1 - s, j1 - s, s))
            i1, j1 = i1 - s, j1 - s
        if i0 == i1 or j0 == j1:
            continue
        if i1 - i0 == 1:
            if (at := next((j for j in range(j0, j1) if b[j] == a[i0]), None)) is not None:
                out.append((i0, at, 1))
            continue
        mid = (i0 + i1) // 2
        total = _zeros(a[i0:mid], b[j0:j1]) + _zeros(a[mid:i1][::-1], b[j0:j1][::-1])[::-1]
        cut = j0 + int(np.argmax(total))
        if int(total.max()) > 0:
            stack += [(i0, mid, j0, cut), (mid, i1, cut, j1)]
    return joined(out)


def joined(runs: list[Run]) -> list[Run]:
    """Runs in order, neighbours on one diagonal as one."""
    out: list[list[int]] = []
    for i, j, n in sorted(runs):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1][2] += n
        else:
            out.append([i, j, n])
    return [tuple(r) for r in out]


def _increasing(js: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tails, ends, back = [], [], [0] * len(js)
    for k, j in enumerate(js):
        at = bisect_left(tails, j)
        back[k] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def _anchored(a: list, b: list) -> list[tuple[int, int, int, int]]:
    """(i, j, length, unique ones) of the stretches around the longest increasing run of anchors, in order."""
    ca, cb, place = Counter(a), Counter(b), {t: j for j, t in enumerate(b)}
    pairs = [(i, place[t]) for i, t in enumerate(a) if ca[t] == 1 and cb.get(t) == 1]
    pairs = [pairs[k] for k in _increasing([j for _, j in pairs])]
    out: list[list[int]] = []
    for i, j in pairs:
        if out and i < out[-1][0] + out[-1][2]:  # reached already from the one before, on the same diagonal
            out[-1][3] += 1
            continue
        low_i, low_j = (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]) if out else (0, 0)
        s, e = 0, 1
        while i - s > low_i and j - s > low_j and a[i - s - 1] == b[j - s - 1]:
            s += 1
        while i + e < len(a) and j + e < len(b) and a[i + e] == b[j + e]:  # stops at an anchor off the diagonal, which equals nothing here
            e += 1
        out.append([i - s, j - s, s + e, 1])
    # the ends of the sequences, where no anchor reaches
    head = tail = 0
    first, last = (out[0][:2], (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2])) if out else ((len(a), len(b)), (0, 0))
    while head < min(first) and a[head] == b[head]:
        head += 1
    while tail < min(len(a) - max(last[0], head), len(b) - max(last[1], head)) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [(0, 0, head, 0)] * (head > 0) + [tuple(r) for r in out] + [(len(a) - tail, len(b) - tail, tail, 0)] * (tail > 0)
    return ends


def pieces(a: list, b: list) -> tuple[list[Run], list[tuple[int, int, int, int]]]:
    """(runs, gaps): matches that lie on a minimal script, and ranges (i0, i1, j0, j1) left to be solved exactly."""
    known = _anchored(a, b)
    done: list[Run] = []
    gaps: list[tuple[int, int, int, int]] = []
    stack = [(0, len(a), 0, len(b), 0, len(known))]
    while stack:
        i0, i1, j0, j1, r0, r1 = stack.pop()
        held = known[r0:r1]
        matched = sum(r[2] for r in held)
        edits = (i1 - i0) + (j1 - j0) - 2 * matched
        at_end = lambda r: (r[0] == i0 and r[1] == j0) or (r[0] + r[2] == i1 and r[1] + r[2] == j1)  # noqa: B023, E731  an equal start or end is always safe
        cuts = [k for k, r in enumerate(held) if 2 * r[3] > edits or at_end(r)]
        if len(cuts) == len(held) or not edits:
            cuts = range(len(held))
        elif not cuts:
            common = sum((Counter(a[i0:i1]) & Counter(b[j0:j1])).values())
            if common == matched:
                cuts = range(len(held))
        if not cuts:
            if i0 < i1 and j0 < j1:
                gaps.append((i0, i1, j0, j1))
            continue
        done += [held[k][:3] for k in cuts]
        i, j, r = i0, j0, r0
        for k in [*cuts, None]:
            e_i, e_j, e_r = (held[k][0], held[k][1], r0 + k) if k is not None else (i1, j1, r1)
            if i < e_i and j < e_j:
                stack.append((i, e_i, j, e_j, r, e_r))
            if k is not None:
                i, j, r = e_i + held[k][2], e_j + held[k][2], r0 + k + 1
    return done, gaps


_RUN = "key string, i long, j long, n long"


#: A gap of at most so many steps is solved where it is found, instead of being dealt.
_STEPS = 1 << 12


def _solved(at: list[int], a: list[int], bt: list[int], b: list[int]) -> list[Run]:
    """The runs of a gap's entries, which lie at places at and bt."""
    return joined([(at[i + k], bt[j + k], 1) for i, j, n in common_runs(a, b) for k in range(n)])


def _laid(a: list[int], b: list[int]) -> Iterator[tuple]:
    """(i, j, n, None, None) for each run of two sequences of hashes, (None, None, None, [places, hashes], [places, hashes]) for each gap left to solve."""
    head, end = 0, min(len(a), len(b))
    while head < end and a[head] == b[head]:
        head += 1
    tail, end = 0, end - head
    while tail < end and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    if head:  # an equal start or end is always safe
        yield 0, 0, head, None, None
    if tail:
        yield len(a) - tail, len(b) - tail, tail, None, None
    mid_a, mid_b = a[head : len(a) - tail], b[head : len(b) - tail]
    in_a, in_b = set(mid_a), set(mid_b)
    if in_a.isdisjoint(in_b):
        return
    ai, bi = [head + i for i, h in enumerate(mid_a) if h in in_b], [head + j for j, h in enumerate(mid_b) if h in in_a]
    ah, bh = [a[i] for i in ai], [b[j] for j in bi]
    runs, gaps = pieces(ah, bh)
    for i, j, n in runs:  # back to places in the whole sequences: entries of one side alone part a run
        yield from ((*run, None, None) for run in joined([(ai[i + k], bi[j + k], 1) for k in range(n)]))
    for i0, i1, j0, j1 in gaps:
        if (i1 - i0) * (j1 - j0) <= _STEPS:
            yield from ((*run, None, None) for run in _solved(ai[i0:i1], ah[i0:i1], bi[j0:j1], bh[j0:j1]))
        else:
            yield None, None, None, [ai[i0:i1], ah[i0:i1]], [bi[j0:j1], bh[j0:j1]]


def matches(old: DataFrame, new: DataFrame, key: str, pos: str, token: Column) -> DataFrame:
    """(key, i, j, n): runs of n entries from old place i and new place j on that match, on one minimal edit script a key.

    Places count from 0 in order of pos within a key. Entries are equal if their tokens' 64-bit hashes are; null is a token. Keys that only
    one side has have no rows; null keys take no part.
    """
    cut = lambda df, side: df.select(F.col(key).cast("string").alias("key"), F.lit(side).alias("side"), F.col(pos).alias("pos"), F.xxhash64(token.isNull(), token).alias("h"))
    both = cut(old, 0).unionByName(cut(new, 1)).where("key is not null")
    # a row a key, so that one batch takes many short documents; a batch of long ones is bounded by its bytes
    rows = both.groupBy("key").agg(F.count_if(F.col("side") == 0).cast("int").alias("m"), F.sort_array(F.collect_list(F.struct("side", "pos", "h"))).alias("x"))
    return _aligned(rows.where((F.col("m") > 0) & (F.col("m") < F.size("x"))).select("key", "m", F.transform("x", lambda x: x["h"]).alias("h")))


def _aligned(pairs: DataFrame) -> DataFrame:
    """matches() of (key, m, h): the hashes of both sides in one list, the old side's m first."""
    lists = pa.list_(pa.list_(pa.int64()))
    kinds = (pa.string(), *[pa.int64()] * 3, lists, lists)

    def skeleton(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "i", "j", "n", "a", "b"]
        for batch in batches:
            held, cols = 0, [[] for _ in kinds]
            at, h = batch.column(2).offsets.to_pylist(), batch.column(2).values.to_numpy(zero_copy_only=False)
            for name, m, lo, hi in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), at, at[1:]):
                for row in _laid(h[lo : lo + m].tolist(), h[lo + m : hi].tolist()):
                    for c, v in zip(cols, (name, *row), strict=True):
                        c.append(v)
                held += hi - lo
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
                    held, cols = 0, [[] for _ in kinds]
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    laid = pairs.mapInArrow(skeleton, f"{_RUN}, a array<array<long>>, b array<array<long>>")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = pc.is_null(batch.column("a"))
            if pc.any(known).as_py():
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(known) for c in range(4)], ["key", "i", "j", "n"])
            out: list[tuple] = []
            for r in batch.filter(pc.invert(known)).to_pylist():
                (at, a), (bt, b) = r["a"], r["b"]
                out += [(r["key"], *run) for run in _solved(at, a, bt, b)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), *[pa.int64()] * 3), strict=True)], ["key", "i", "j", "n"])

    dealt = laid.repartition(F.col("key"), F.coalesce("i", F.get(F.get("a", F.lit(0)), F.lit(0))))  # gaps of one key go to many tasks
    return dealt.mapInArrow(solve, _RUN)


def _met(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by keys and places, sorted and merged: planned by the texts' file, much smaller than rows a line, it would be a broadcast."""
    return left.join(right.hint("merge"), list(on), how)


def _numbered(df: DataFrame, key: str, pos: str, *extra: Column) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), (F.row_number().over(W.partitionBy(F.col(key).cast("string")).orderBy(pos)) - 1).cast("long").alias("at"), F.col(pos).cast("int").alias("pos"), *extra)


def line_counts(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """(key, added, removed): lines added and removed by a minimal edit script between two texts of a key, which must be unique.

    A line feed ends a line, so a last empty piece is no line. A key that one side lacks has all lines of the other.
    """
    lines = lambda df: df.select(F.col(key).cast("string").alias("key"), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    a, b = lines(old), lines(new)
    size = lambda df, name: df.groupBy("key").agg(F.count("*").alias(name))
    kept = matches(a, b, "key", "pos", F.col("line")).groupBy("key").agg(F.sum("n").alias("kept"))
    keys = old.select(F.col(key).cast("string").alias("key")).unionByName(new.select(F.col(key).cast("string").alias("key"))).distinct()
    total = _met(_met(_met(keys, size(a, "a"), ["key"], "left"), size(b, "b"), ["key"], "left"), kept, ["key"], "left").na.fill(0, ["a", "b", "kept"])
    return total.select("key", (F.col("b") - F.col("kept")).alias("added"), (F.col("a") - F.col("kept")).alias("removed"))


def _lines(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def changes(old: DataFrame, new: DataFrame, key: str, pos: str, token: Column) -> DataFrame:
    """(key, kind, old_at, new_at): replace, delete and insert by place, on one minimal script.

    Between two matches, entries of both sides pair in order as replaced; what is over on one side is deleted or inserted.
    """
    runs = matches(old, new, key, pos, token)
    n = lambda df, name: df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias(name))
    sizes = _met(n(old, "a"), n(new, "b"), ["key"], "full").na.fill(0, ["a", "b"])
    ends = sizes.select("key", F.col("a").alias("i"), F.col("b").alias("j"), F.lit(0).cast("long").alias("n"))
    by = W.partitionBy("key").orderBy("i", "j", "n")
    before = lambda c: F.coalesce(F.lag(F.col(c) + F.col("n")).over(by), F.lit(0).cast("long"))
    holes = runs.unionByName(ends).select("key", before("i").alias("i0"), F.col("i").alias("i1"), before("j").alias("j0"), F.col("j").alias("j1")).where("i0 < i1 or j0 < j1")
    wide = holes.select("key", "i0", "i1", "j0", "j1", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("i1") - F.col("i0"), F.col("j1") - F.col("j0")) - 1)).alias("k"))
    old_at, new_at = F.when(F.col("i0") + F.col("k") < F.col("i1"), F.col("i0") + F.col("k")), F.when(F.col("j0") + F.col("k") < F.col("j1"), F.col("j0") + F.col("k"))
    placed = wide.select("key", old_at.alias("old_at"), new_at.alias("new_at"))
    kind = F.when(F.col("new_at").isNull(), "delete").when(F.col("old_at").isNull(), "insert").otherwise("replace")
    return placed.select("key", kind.alias("kind"), "old_at", "new_at")


def block_diff(old: DataFrame, new: DataFrame, key: str, text: str, pos: str, token: Column) -> DataFrame:
    """(key, kind, old_pos, new_pos, old_text, new_text, before, after): changes() with texts and the neighbours on the new side (for
    what is deleted, on the old side); blank where there is none."""
    near = lambda step: F.coalesce(step(text).over(W.partitionBy(F.col(key).cast("string")).orderBy(pos)), F.lit(""))
    side = lambda df, s: _numbered(df, key, pos, F.col(text).alias("text"), near(F.lag).alias("before"), near(F.lead).alias("after")).select(F.col("key"), *[F.col(c).alias(f"{s}_{c}") for c in ("at", "pos", "text", "before", "after")])
    found = changes(old, new, key, pos, token)
    met = _met(_met(found, side(old, "old"), ["key", "old_at"], "left"), side(new, "new"), ["key", "new_at"], "left")
    pick = lambda c: F.when(F.col("new_at").isNull(), F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c)
    return met.select("key", "kind", "old_pos", "new_pos", "old_text", "new_text", pick("before"), pick("after"))


#: Where the lines of a merge come from; base's from base, theirs' and conflict_theirs' from theirs, all others from ours.
ORIGINS = ("base", "ours", "theirs", "both", "conflict_ours", "conflict_theirs")

#: Texts of at most so many bytes are merged where they meet; the gaps of longer ones are dealt.
_WHOLE = 1 << 16


def _merged(b: list, o: list, t: list, ours: list[Run], theirs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(place in ORIGINS, start in that side, length) of the stretches of a merge, in order, by the runs that base and either side share."""
    ours, theirs = sorted(ours), sorted(theirs)
    stable, x, y = [], 0, 0
    while x < len(ours) and y < len(theirs):
        (i, j, n), (k, h, m) = ours[x], theirs[y]
        lo, hi = max(i, k), min(i + n, k + m)
        if lo < hi:
            stable.append((lo, j + lo - i, h + lo - k, hi - lo))
        x, y = (x + 1, y) if i + n < k + m else (x, y + 1)
    b0 = o0 = t0 = 0
    for b1, o1, t1, n in [*stable, (len(b), len(o), len(t), 0)]:
        was, mine, other = b[b0:b1], o[o0:o1], t[t0:t1]
        if mine == was:
            kinds = (0,) if other == was else (2,)
        else:
            kinds = (1,) if other == was else (3,) if mine == other else (4, 5)
        for kind in kinds:
            start, end = (b0, b1) if kind == 0 else (t0, t1) if kind in (2, 5) else (o0, o1)
            if start < end:
                yield kind, start, end - start
        if n:
            yield 0, b1, n
        b0, o0, t0 = b1 + n, o1 + n, t1 + n


def _runs(a: list[int], b: list[int]) -> list[Run]:
    """All runs of two sequences of hashes, gaps solved here."""
    out: list[Run] = []
    for i, j, n, old, new in _laid(a, b):
        out += [(i, j, n)] if old is None else _solved(*old, *new)
    return out


def _given(runs: pa.Array, row: int) -> list[Run]:
    return [(r["i"], r["j"], r["n"]) for r in runs[row].as_py()]


@arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("kind", "at", "n")])))
def _stretches(loose: pa.Array, base: pa.Array, ours: pa.Array, theirs: pa.Array, runs_o: pa.Array, runs_t: pa.Array) -> pa.Array:
    """_merged of the hashes of three texts a row: by runs where there are some, else aligned here; what is loose is not aligned."""
    slots = [(x.offsets.to_pylist(), x.values.to_numpy(zero_copy_only=False)) for x in (base, ours, theirs)]
    ends, cols = [0], ([], [], [])
    for r, free in enumerate(loose.to_pylist()):
        b, o, t = (h[at[r] : at[r + 1]].tolist() for at, h in slots)
        found = ([], []) if free else [_given(x, r) if x[r].is_valid else _runs(b, side) for x, side in ((runs_o, o), (runs_t, t))]
        for row in _merged(b, o, t, *found):
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        ends.append(len(cols[0]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in cols], ["kind", "at", "n"]))


def _all_lines(side: str) -> Column:
    return F.flatten(F.transform(side, lambda x: _lines(x["text"]))).alias(side)


def _hashes(lines: str) -> Column:
    return F.transform(lines, lambda x: F.xxhash64(x))


def _gathered(sides: dict[str, DataFrame], key: str, text: str) -> list[DataFrame]:
    """(key, loose, a list of structs of a text for each side), loose being the null key: of keys whose texts have at most _WHOLE bytes each, and of the other keys."""
    k, on = F.col(key).cast("string"), ["key", "loose"]  # without nulls in the keys of the joins, both read the texts by one exchange
    cut = [df.select(F.coalesce(k, F.lit("")).alias("key"), k.isNull().alias("loose"), F.lit(s).alias("side"), F.col(text).alias("text")) for s, df in enumerate(sides.values())]
    texts = cut[0].unionByName(cut[1]).unionByName(cut[2])
    # keys with a text above the bound are few or none, which is known before the texts are read
    wide = texts.where((F.octet_length("text") > _WHOLE) & ~F.col("loose")).select(on).distinct()
    mine = [F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("text")))).alias(name) for s, name in enumerate(sides)]
    return [_met(texts, wide, on, how).groupBy(on).agg(*mine) for how in ("left_anti", "left_semi")]


_RUNS = "array<struct<i: bigint, j: bigint, n: bigint>>"


def _no_runs(others: Sequence[str]) -> list[Column]:
    """Columns of runs for rows that are aligned where they meet."""
    return [F.lit(None).cast(_RUNS).alias(f"runs_{s}") for s in others]


def _dealt(df: DataFrame, first: str, *others: str) -> DataFrame:
    """df, a row a key with a list of lines for each side, and the runs of the first side's lines and those of each other, gaps dealt to all tasks."""
    shared = [_aligned(df.select("key", F.size(first).alias("m"), F.concat(_hashes(first), _hashes(s)).alias("h"))).withColumn("side", F.lit(s)) for s in others]
    listed = [F.collect_list(F.when(F.col("side") == s, F.struct("i", "j", "n"))).alias(f"runs_{s}") for s in others]
    found = shared[0].unionByName(shared[1]).groupBy("key").agg(*listed)
    return _met(df, found, ["key"], "left").select(*df.columns, *[F.coalesce(f"runs_{s}", F.array().cast(_RUNS)).alias(f"runs_{s}") for s in others])


def merged3(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, at, line, origin): the three-way merge of texts by lines.

    Base lines that match on both sides are stable and cut a text into chunks. A chunk that one side left as it was takes the other
    side's lines; if both made the same of it, those; else all of ours, then all of theirs, with origin conflict_ours and
    conflict_theirs. origin is otherwise base, ours, theirs or both. A side that lacks a key has an empty text. Texts of one key on one side
    follow one another, sorted. Texts of the null key are not aligned.

    The three texts of a key meet in one row, and only their lines' hashes go to Python; what comes back are stretches, whose lines are cut from the texts.
    """
    names = ("base", "ours", "theirs")
    short, long = (df.select("key", "loose", *[_all_lines(s) for s in names]) for df in _gathered(dict(zip(names, (base, ours, theirs), strict=True)), key, text))
    rows = short.select("*", *_no_runs(names[1:])).unionByName(_dealt(long, *names))
    rows = rows.select("key", "loose", *names, _stretches("loose", *map(_hashes, names), "runs_ours", "runs_theirs").alias("made"))
    side = lambda r: F.when(r["kind"] == 0, F.col("base")).when(r["kind"].isin(2, 5), F.col("theirs")).otherwise(F.col("ours"))
    origin = lambda r: F.element_at(F.array(*map(F.lit, ORIGINS)), r["kind"] + 1)
    lines = F.flatten(F.transform("made", lambda r: F.transform(F.slice(side(r), r["at"] + 1, r["n"]), lambda x: F.struct(x.alias("line"), origin(r).alias("origin")))))
    return rows.select(F.when(~F.col("loose"), F.col("key")).alias("key"), F.posexplode(lines).alias("at", "x")).select("key", "at", "x.line", "x.origin")


#: What marks a slot in a template line.
SLOT = r"\|[A-Z0-9][A-Z0-9_]+\|"


def _shape(line: str) -> str:
    """The kind of a line of markup, by which a refreshed line may stand in for another."""
    bare = line.strip()
    if not bare:
        return "blank"
    if bare.startswith("..") and bare[2:3] in ("", " "):
        return "directive"
    if re.match(r":[A-Za-z][\w-]*:", bare):
        return "option"
    if bare.startswith("+") and not set(bare) - set("+-="):
        return "border"
    return "row" if bare[0] == bare[-1] == "|" and bare.count("|") > 2 else "text"


def refreshed_line(template: str, built: str, reviewed: str, slot: str = SLOT) -> str:
    """reviewed with the slots of template filled as in built, if both still are that line with its slots filled; else reviewed."""
    fixed = re.split(slot, template)
    filled = re.compile("(.*?)".join(map(re.escape, fixed)), re.DOTALL)
    values = filled.fullmatch(built)
    if len(fixed) < 2 or values is None or filled.fullmatch(reviewed) is None or _shape(reviewed) != _shape(template):
        return reviewed
    return "".join(f + v for f, v in zip(fixed, [*values.groups(), ""], strict=True))


def _stands(runs: list[Run], size: int, other: int, places: list[int]) -> dict[int, int]:
    """Where the entries at some rising places of a sequence stand in another: at their match, or within a changed stretch as far along."""
    out, left, i0, j0 = {}, iter(places), 0, 0
    at = next(left, size)
    for i, j, n in [*sorted(runs), (size, other, 0)]:
        a, b = i - i0, j - j0
        while at < i:
            if b:
                out[at] = j0 + (at - i0 if a == b else round((at - i0) * (b - 1) / max(a - 1, 1)))
            at = next(left, size)
        while at < i + n:
            out[at] = j + at - i
            at = next(left, size)
        i0, j0 = i + n, j + n
    return out


def _cut(text: str | None) -> list[str]:
    """The lines of a text, as by _lines."""
    lines = (text or "").split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def refreshed_text(template: list[str], built: list[str], review: str | None, to_built: list[Run] | None = None, to_review: list[Run] | None = None) -> str | None:
    """A reviewed text with the slots of its template's lines filled anew from the built text's, by given runs or by aligning them here."""
    slots = [i for i, line in enumerate(template) if re.search(SLOT, line)]
    lines = _cut(review)
    if not slots or not built or not lines:
        return review
    ids: dict[str, int] = {}
    t, b, r = ([ids.setdefault(x, len(ids)) for x in side] for side in (template, built, lines))
    in_b = _stands(_runs(t, b) if to_built is None else to_built, len(t), len(b), slots)
    in_r = _stands(_runs(t, r) if to_review is None else to_review, len(t), len(r), slots)
    new: dict[int, str] = {}
    for i in slots:  # several template lines can stand for one reviewed line: the last that fits it wins, so each is tried on the line as reviewed
        if i in in_b and i in in_r:
            made = refreshed_line(template[i], built[in_b[i]], lines[in_r[i]])
            if made != lines[in_r[i]]:
                new[in_r[i]] = made
    return "\n".join([new.get(j, x) for j, x in enumerate(lines)]) + "\n" * review.endswith("\n") if new else review


@arrow_udf(T.StringType())
def _refreshed(template: pa.Array, built: pa.Array, review: pa.Array, runs_b: pa.Array, runs_r: pa.Array) -> pa.Array:
    out = []
    for k in range(len(review)):
        t, b = ([line for x in side[k].as_py() for line in _cut(x)] for side in (template, built))
        out.append(refreshed_text(t, b, review[k].as_py(), *[_given(x, k) if x[k].is_valid else None for x in (runs_b, runs_r)]))
    return pa.array(out, pa.string())


def refreshed(template: DataFrame, built: DataFrame, review: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): reviewed texts with the slots of their template's lines filled anew from the built text.

    A template line with slots is looked up in both texts by alignment. The reviewed line is written anew only if it still is the template's line with
    its slots filled, and of the same shape of markup; whatever else a reviewer wrote stays. A key without a review takes the built text, one
    without a template or a built text stays as reviewed, as do texts of the null key. Line feeds part lines; a last one stays as the review has it.
    Several templates or built texts of one key follow one another, sorted; several reviews are refreshed each.

    The texts of a key meet in one row.
    """
    names = ("template", "built", "review")
    named = {s: df.where(F.col(key).isNotNull()) for s, df in zip(names, (template, built, review), strict=True)}
    whole = lambda side, seen: F.transform(side, lambda x: F.struct(x["text"].alias("text"), F.lit(seen).alias("seen")))
    rows = lambda df: df.select("key", "template", "built", F.posexplode(F.when(F.size("review") > 0, whole("review", True)).otherwise(whole("built", False))).alias("pos", "x")).select("key", "pos", "template", "built", "x.*")
    short, long = map(rows, _gathered(named, key, text))
    texts = lambda side: F.transform(side, lambda x: x["text"]).alias(side)
    lines = long.where("seen").select(F.concat("pos", F.lit("/"), "key").alias("key"), _all_lines("template"), _all_lines("built"), _lines(F.col("text")).alias("review"))
    runs = _dealt(lines, *names).select("key", "runs_built", "runs_review")
    solved = _met(long.withColumn("id", F.concat("pos", F.lit("/"), "key")), runs.withColumnRenamed("key", "id"), ["id"], "left").drop("id")
    both = short.select("*", *_no_runs(names[1:])).unionByName(solved)
    made = both.select("key", "text", "seen", _refreshed(texts("template"), texts("built"), "text", "runs_built", "runs_review").alias("new"))
    loose = [df.where(F.col(key).isNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")) for df in (review, built)]
    return made.select("key", F.when(F.col("seen"), F.col("new")).otherwise(F.col("text")).alias("text")).unionByName(loose[0]).unionByName(loose[1])
