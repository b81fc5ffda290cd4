"""Product quantisation of vectors in whole numbers: codes, codebooks and errors that any machine computes alike.

Components become floor(scale * x). Vectors are cut into equal parts, and each part position has a codebook that starts
as that part of the vectors of least id and is moved `rounds` times to the floored means of what is nearest to its entries.

The nearest entry is found by segment-mean lower bounds. Cut a part and an entry into blocks: the squared distance is at least
the sum over blocks of size s of (difference of sums)^2 / s, plus the square of the difference of the residuals'
norms, where a residual is what a vector has beside its block means. Bounds are taken with one block, then two, four and
so on; at each level the entry of least bound is measured, and entries whose bound, less a margin for rounding, lies above
the least distance measured are out. What survives all levels is measured exactly, in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, small, written

#: Whole components below this are int64 (their squared distances over a thousand components still are); others are Python integers.
_NARROW = 1 << 25
_LIMB = 32


def levels(width: int) -> list[np.ndarray]:
    """Starts of the blocks on each level: 1, 2, 4, ... blocks, of two components at least."""
    out, blocks = [], 1
    while blocks == 1 or width // blocks >= 2:
        out.append(np.arange(blocks) * width // blocks)
        blocks *= 2
    return out


class _Bounds:
    """Block sums and residual norms of the rows of x, level by level."""

    def __init__(self, x: np.ndarray):
        f, width = x.astype(np.float64), x.shape[1]
        self.square = (f * f).sum(axis=1)
        self.at = []
        for starts in levels(width):
            size = np.diff(np.append(starts, width))
            sums = np.add.reduceat(f, starts, axis=1)
            rest = f - np.repeat(sums / size, size, axis=1)
            self.at.append((sums / np.sqrt(size), np.sqrt((rest * rest).sum(axis=1))))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=1)


class Codebook:
    """The entries of one part position, with what their bounds need."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.wide = entries.dtype == object
        self.bounds = None if self.wide else _Bounds(entries)
        self.measured = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry to each row of x, ties to the lower index."""
        if self.wide or x.dtype == object:
            return self._plain(x.astype(object))
        n, k = len(x), len(self.entries)
        own, least = _Bounds(x), np.full(n, np.iinfo(np.int64).max)
        row, entry = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
        for (sums, rest), (e_sums, e_rest) in zip(own.at, self.bounds.at, strict=True):
            if len(row) == n * k:  # all pairs: as a product
                between = (sums * sums).sum(1)[:, None] - 2 * (sums @ e_sums.T) + (e_sums * e_sums).sum(1)[None, :]
                bound = (between + (rest[:, None] - e_rest[None, :]) ** 2).ravel()
            else:
                bound = ((sums[row] - e_sums[entry]) ** 2).sum(axis=1) + (rest[row] - e_rest[entry]) ** 2
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            low = np.minimum.reduceat(bound, first)
            tip = np.flatnonzero(bound == np.repeat(low, np.diff(np.append(first, len(row)))))
            tip = tip[np.append(True, row[tip[1:]] != row[tip[:-1]])]  # the first entry of least bound, for each row
            least = np.minimum(least, _exact(x, self.entries[entry[tip]]))
            self.measured += n
            keep = bound - 1e-9 * (own.square[row] + self.bounds.square[entry] + 1) <= least[row]
            row, entry = row[keep], entry[keep]
        self.measured += len(row)
        dist = _exact(x[row], self.entries[entry])
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        best = np.minimum.reduceat(dist, first)
        hit = np.flatnonzero(dist == np.repeat(best, np.diff(np.append(first, len(row)))))
        hit = hit[np.append(True, row[hit[1:]] != row[hit[:-1]])]
        return entry[hit], best

    def _plain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In Python integers, for components of any size."""
        entries = self.entries.astype(object)
        found = [min((int(d), k) for k, d in enumerate(_exact(np.broadcast_to(r, entries.shape), entries))) for r in x]
        return np.array([k for _, k in found], np.int64), np.array([d for d, _ in found], object)


def packed(vectors: np.ndarray, scale: int) -> list[bytes]:
    """floor(scale * x) of the rows: eight bytes a component behind a zero byte, or decimals behind a one where any component is wide."""
    with np.errstate(over="ignore"):
        whole = np.floor(vectors * scale)
    narrow = (np.abs(whole) < _NARROW).all(axis=1)
    safe = np.where(narrow[:, None], whole, 0).astype("<i8")
    exact = lambda v: int(v) * scale if abs(v) >= 1 << 53 else int(np.floor(v * scale))  # noqa: E731  from there on v is whole itself
    return [b"\0" + s.tobytes() if fine else b"\1" + ",".join(str(exact(v)) for v in x).encode() for fine, s, x in zip(narrow, safe, vectors, strict=True)]


def unpacked(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for the rows in int64 and for those in Python integers."""
    wide = np.array([r[:1] == b"\1" for r in rows], bool)
    if not wide.all():
        yield np.flatnonzero(~wide), np.frombuffer(b"".join(r[1:] for r in rows if r[:1] == b"\0"), "<i8").reshape(int((~wide).sum()), -1)
    if wide.any():
        yield np.flatnonzero(wide), np.array([[int(v) for v in r[1:].split(b",")] for r in rows if r[:1] == b"\1"], object)


def _array(rows: list[list[int]]) -> np.ndarray:
    """int64 if all are narrow, else Python integers."""
    return np.array(rows, np.int64 if all(abs(v) < _NARROW for r in rows for v in r) else object)


def usable(vectors: DataFrame, parts: int, scale: int, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """(id, label, v): a written table of the vectors that take part, each packed in whole numbers."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    common = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    kept = fine.where(F.size("v") == (common["n"] if common else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                whole = packed(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), scale)
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(whole, pa.binary())], ["id", "label", "v"])

    schema = kept.schema
    return written(arrow_map(kept, run, f"id long, label {schema['label'].dataType.simpleString()}, v binary"))


def _first_entries(vectors: DataFrame, entries: int, parts: int) -> list[np.ndarray]:
    """Codebooks of the vectors of the least ids, nulls last; of rows that repeat an id, the one of least bytes."""
    least = vectors.groupBy("id").agg(F.min("v").alias("v")).orderBy(F.col("id").asc_nulls_last()).limit(entries).collect()
    rows = [None] * len(least)
    for at, x in unpacked([bytes(r["v"]) for r in least]):
        for i, v in zip(at, x.tolist(), strict=True):
            rows[i] = v
    width = len(rows[0]) // parts if rows else 0
    return [_array([r[p * width : (p + 1) * width] for r in rows]) for p in range(parts)] if rows else []


def _moved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floored mean of the parts nearest to it, or as it was if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sums = [Codebook(b) for b in books], {}
        for b in batches:
            for _, x in unpacked(b.column(0).to_pylist()):
                for p, book in enumerate(found):
                    width = book.entries.shape[1]
                    part = x[:, p * width : (p + 1) * width]
                    for at in range(0, len(part), 4096):
                        cut = part[at : at + 4096]
                        code, _ = book.nearest(cut)
                        order = np.argsort(code, kind="stable")
                        used, first, count = np.unique(code[order], return_index=True, return_counts=True)
                        for k, s, c in zip(used.tolist(), np.add.reduceat(cut[order], first, axis=0).tolist(), count.tolist(), strict=True):
                            held = sums.setdefault((p, k), [0, [0] * width])
                            held[0] += c
                            held[1] = [a + b for a, b in zip(held[1], s, strict=True)]
        out = []
        for (p, k), (c, s) in sums.items():
            out.append((p, k, -1, 0, c))
            for j, v in enumerate(s):
                limb = 0
                while True:  # 32 bits a limb, the last one signed, so that sums of any size add up in 64 bits
                    last = -(1 << _LIMB) <= v < 1 << _LIMB
                    out.append((p, k, j, limb, v if last else v & ((1 << _LIMB) - 1)))
                    if last:
                        break
                    v, limb = v >> _LIMB, limb + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["p", "k", "j", "limb", "s"])

    partial = arrow_map(vectors.select("v"), run, "p long, k long, j long, limb long, s long")
    rows = partial.groupBy("p", "k", "j", "limb").agg(F.sum("s").alias("s")).collect()  # as many as the codebooks have components
    total: dict[tuple[int, int, int], int] = {}
    for r in rows:
        total[r["p"], r["k"], r["j"]] = total.get((r["p"], r["k"], r["j"]), 0) + (r["s"] << (_LIMB * r["limb"]))
    new = []
    for p, book in enumerate(books):
        kept = book.tolist()
        for k in range(len(kept)):
            if (count := total.get((p, k, -1))) is not None:
                kept[k] = [total[p, k, j] // count for j in range(len(kept[k]))]
        new.append(_array(kept))
    return new


def codebooks_text(books: list[np.ndarray]) -> str:
    """All components in decimal, by part, entry and place, comma-joined."""
    return ",".join(str(v) for book in books for entry in book.tolist() for v in entry)


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, label, codes array<int>, error), codebooks): the nearest entry of each part, 0-based, and the summed squared distances.

    Null vectors, empty ones and those with null or non-finite components take no part; of vectors of different lengths only those of
    the commonest (then the shorter) length that `parts` divides do. Null ids take part and come last among the first entries. Rows that
    repeat are coded each; one of them serves as a first entry. An error beyond 64 bits is null. No vectors: no rows and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte")
    table = usable(vectors, parts, scale, id_col, vector_col, label_col)
    books = _first_entries(table, entries, parts)
    for _ in range(rounds if books else 0):
        books = _moved(table, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Codebook(b) for b in books]
        for b in batches:
            codes, errors = np.zeros((b.num_rows, parts), np.int32), [0] * b.num_rows
            for at, x in unpacked(b.column(2).to_pylist()):
                for p, book in enumerate(found):
                    width = book.entries.shape[1]
                    for s in range(0, len(at), 4096):
                        code, dist = book.nearest(x[s : s + 4096, p * width : (p + 1) * width])
                        codes[at[s : s + 4096], p] = code
                        for i, d in zip(at[s : s + 4096].tolist(), dist.tolist(), strict=True):
                            errors[i] += d
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array(list(codes), pa.list_(pa.int32())), pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())], ["id", "label", "codes", "error"]
            )

    label = table.schema["label"].dataType.simpleString()
    return arrow_map(table, run, f"id long, label {label}, codes array<int>, error long"), books


def decoded(codes: pd.Series, books: list[np.ndarray]) -> np.ndarray:
    """The whole-number vectors that codes stand for."""
    return np.stack([np.concatenate([book[c] for book, c in zip(books, row, strict=True)]) for row in codes])


def digests(vectors: DataFrame, **settings: int) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (error summed over equal labels, nulls together; null if one lacks or
    the sum leaves 64 bits), codebooks_sha256, for the rows of compress()."""
    coded, books = compress(vectors, **settings)
    coded = written(coded)
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count(F.when(F.col("error").isNull(), 1)).alias("lost"))
    label_error = F.when((F.col("lost") == 0) & (F.col("s") <= F.lit((1 << 63) - 1)), F.col("s")).cast("long")
    sums = written(sums.select(F.col("label").alias("l"), label_error.alias("label_error")))
    joined = coded.join(F.broadcast(sums) if small(sums) else sums, F.col("label").eqNullSafe(F.col("l")))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return joined.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
