"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

A text's terms are its lower-cased words cut to `stem` letters, so that inflections share one. All terms of the
labelled sample that two of its texts hold are the vocabulary, and all examples are in the index: for every term a
posting list of (example, weight) in example order, cut into blocks of examples that know their greatest weight. A
query adds the block maxima of its terms to bound what any example of a block can score, adds up the blocks of the
highest bounds, and then those others whose bound can still reach the k-th best: the k nearest are exact. Their labels
vote, weighed by a power of the cosine in proportion to the nearest's, drawn to the base rate by a prior. Examples are
stratified by label; votes are weighed back to the labelled rows' own rates, which keeps the score calibrated.

A term's weight is (1 + ln tf) x idf x lean. The lean is never zero: it grows with how much more often than by chance
the term stands in texts of label 1, so that two texts are near for what the labels are about before they are near
for their common words. With idf alone the nearest examples are those of like subject.

The fit reads at most 2 x `per_label` examples, the only bound; every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, written

_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def stems(text: str | None, stem: int) -> list[str]:
    return [w[:stem] for w in _WORD.findall((text or "").lower())]


@dataclass
class Index:
    """terms and their gain (idf x lean); cells by term: block, greatest weight and first posting; postings by cell:
    example, weight; rows: the posting lists of common terms, an entry for every example, and the row of a term or -1;
    label, share (of the labelled rows that an example stands for) and id by example."""

    terms: dict[str, int]
    gain: np.ndarray
    stem: int
    cell_start: np.ndarray
    cell_block: np.ndarray
    cell_max: np.ndarray
    post_start: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    row_of: np.ndarray
    rows: np.ndarray
    label: np.ndarray
    share: np.ndarray
    ids: np.ndarray
    base: float
    block: int
    blocks: int
    k: int
    power: float
    prior: float

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, unit weights) of a text's TF-IDF vector; empty if it holds no term."""
        known = self.terms
        found = sorted((known[t], c) for t, c in Counter(stems(text, self.stem)).items() if t in known)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        at, tf = np.array(found, np.int64).T
        w = (1 + np.log(tf)) * self.gain[at]
        return at, w / np.linalg.norm(w)

    def nearest(self, at: np.ndarray, w: np.ndarray, first: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine above zero; ties go to the smaller id.

        The `first` blocks of highest bound set the k-th best; then all others whose bound can reach it are added up.
        """
        row = self.row_of[at]
        score = w[row >= 0] @ self.rows[row[row >= 0]] if (row >= 0).any() else np.zeros(len(self.ids))  # the common terms' part
        cells, of = _ranges(self.cell_start[at], self.cell_start[at + 1])
        block, gain = self.cell_block[cells], w[of]
        begins = np.arange(self.blocks) * self.block
        bound = np.bincount(block, gain * self.cell_max[cells], self.blocks) + (np.maximum.reduceat(score, begins) if len(score) else 0.0)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        e, s = self._best(score, cells, gain, block, order[:first])
        if len(order) > first:
            if len(s) == self.k:
                order = order[bound[order] >= s[-1] - 1e-9]
            e, s = self._best(score, cells, gain, block, order)
        return e, s

    def _best(self, common: np.ndarray, cells: np.ndarray, gain: np.ndarray, block: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest in the given blocks: the postings of their cells added up by example, and the common part."""
        chosen = np.zeros(self.blocks, bool)
        chosen[blocks] = True
        inside = np.flatnonzero(chosen[block])
        posts, own = _ranges(self.post_start[cells[inside]], self.post_start[cells[inside] + 1])
        score = common + np.bincount(self.example[posts], self.weight[posts] * gain[inside][own], len(self.ids))
        e = np.flatnonzero(np.repeat(chosen, self.block)[: len(score)] & (score > 0))
        s = score[e]
        if len(s) > self.k:
            able = s >= np.partition(s, -self.k)[-self.k]
            e, s = e[able], s[able]
        top = np.lexsort((self.ids[e], -s))[: self.k]
        return e[top], s[top]

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float, int]]]:
        at, w = self.vector(text)
        if not len(at):
            return self.base, []
        near, cosine = self.nearest(at, w)
        vote = (cosine / cosine.max(initial=1e-12)) ** self.power * self.share[near]
        p = (vote @ self.label[near] + self.prior * self.base) / (vote.sum() + self.prior)
        return float(min(1.0, max(0.0, p))), list(zip(self.ids[near].tolist(), cosine.tolist(), self.label[near].tolist(), strict=True))


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the ranges [lo, hi), which range each is of)."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) + (lo - np.cumsum(n) + n)[of], of


def indexed(vectors: list[tuple[np.ndarray, np.ndarray]], block: int, n_terms: int, common: float = 0.125) -> dict[str, np.ndarray | int]:
    """The lists of an Index over the examples' (terms, weights); a term is common that so much of them hold."""
    at = np.concatenate([np.zeros(0, np.int64), *(v[0] for v in vectors)]).astype(np.int64)
    weight = np.concatenate([np.zeros(0), *(v[1] for v in vectors)])
    who = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
    often = np.bincount(at, minlength=n_terms) > max(block, common * len(vectors))
    row_of = np.where(often, np.cumsum(often) - 1, -1)
    rows = np.zeros((int(often.sum()), len(vectors)))
    rows[row_of[at[often[at]]], who[often[at]]] = weight[often[at]]
    at, who, weight = (x[~often[at]] for x in (at, who, weight))
    order = np.lexsort((who, at))
    at, who, weight = at[order], who[order], weight[order]
    blocks = max(1, -(-len(vectors) // block))
    cell = at * blocks + who // block
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    return {
        "cell_start": np.searchsorted(at[first], np.arange(n_terms + 1)), "cell_block": cell[first] % blocks, "cell_max": np.maximum.reduceat(weight, first) if len(first) else np.zeros(0),
        "post_start": np.append(first, len(cell)), "example": who, "weight": weight, "row_of": row_of, "rows": rows, "block": block, "blocks": blocks,
    }


def sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, y) for at most per_label training rows of each label, lowest doc_id hash first, and each
    label's number of training rows by those sampled. Rows with a null id or label teach nothing, nor do labels
    other than 0 and 1; of labels that repeat a doc_id the greatest counts; of documents that repeat one, the text
    of least hash."""
    train = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    train = written(train.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).where("y in (0, 1)"))
    counts = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    picked = None
    for y in (0, 1):
        part = train.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = part if picked is None else picked.unionByName(part)
    picked = written(picked)  # at most 2 * per_label ids: safe to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
    one = texts.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    return one.select("doc_id", "text", "y"), {y: n / min(n, per_label) for y, n in counts.items()}


def _counts(texts: DataFrame, stem: int) -> DataFrame:
    """(term, y, docs, settings): in how many different texts of each label a term stands, and beside how many different
    pairs of neighbours; copies of a text, near ones too, hardly add to the second."""

    def rows(held: Counter, beside: set) -> pa.RecordBatch:
        cols = list(zip(*[(t, y, None, n) for (t, y), n in held.items()], *[(t, y, s, 0) for t, y, s in beside], strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["term", "y", "setting", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: Counter[tuple[str, int]] = Counter()
            beside: set[tuple[str, int, int]] = set()
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = stems(text, stem)
                held.update((t, y) for t in set(words))
                for before, t, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                    beside.add((t, y, xxhash.xxh64_intdigest(f"{before} {after}") >> 1))
                if len(beside) > 50_000:  # what is held stays small; equal rows meet in the aggregate
                    yield rows(held, beside)
                    held, beside = Counter(), set()
            yield rows(held, beside)

    each = arrow_map(texts.select("text", "y"), run, "term string, y int, setting long, docs long").groupBy("term", "y", "setting").agg(F.sum("docs").alias("docs"))
    return each.groupBy("term", "y").agg(F.sum("docs").alias("docs"), F.count("setting").alias("settings"))


def fit(
    docs: DataFrame, labels: DataFrame, per_label: int = 2000, stem: int = 5, floor: float = 0.1, slope: float = 0.5, sure: float = 2.0, k: int = 20, power: float = 2.0, prior: float = 0.3, block: int = 64
) -> Index:
    """Fit the index on a bounded sample of the labelled rows outside the held-out fold.

    A term's lean is floor + slope x z, z being by how many standard deviations beyond `sure` it stands in more texts of
    label 1 than those of label 0 let expect, or 0. Both are counted as the lesser of the different texts and
    the different pairs of neighbours, so that many copies of one text do not teach that text's words. Without labelled
    rows, or of one label alone, the index has that base rate and whatever neighbours there are.
    """
    examples, scale = sample(docs, labels, per_label)
    examples = written(examples)
    texts = written(examples.select("y", "text").distinct())
    different = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    lesser = F.least("docs", "settings")
    wide = _counts(texts, stem).groupBy("term").agg(F.sum("docs").alias("docs"), *[F.coalesce(F.sum(F.when(F.col("y") == y, lesser)), F.lit(0)).alias(f"p{y}") for y in (0, 1)])
    rows = wide.where("docs > 1").orderBy("term").toArrow()  # bounded by the sample
    n, p0, p1 = (rows.column(c).to_numpy().astype(float) for c in ("docs", "p0", "p1"))
    expected = (p0 + 1) * max(different.get(1, 0), 1.0) / (different.get(0, 0) + 1.0)
    lean = floor + slope * np.maximum(0.0, (p1 - expected) / np.sqrt(expected + 1) - sure)
    terms = {t: i for i, t in enumerate(rows.column("term").to_pylist())}
    none = np.zeros(0)
    model = Index(terms, np.log(1 + sum(different.values()) / np.maximum(n, 1)) * lean, stem, *[none] * 11, 0.0, 1, 1, k, power, prior)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.vector(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.float64()))], ["doc_id", "y", "at", "w"])

    vecs = arrow_map(examples.select("doc_id", "text", "y"), vectors, "doc_id long, y int, at array<long>, w array<double>").orderBy("doc_id").toArrow()
    held = [(np.asarray(a.values), np.asarray(w.values)) for a, w in zip(vecs.column("at"), vecs.column("w"), strict=True)]
    ahead = np.array([[*a[np.argsort(-w / model.gain[a], kind="stable")[:2]], -1, -1][:2] for a, w in held]).reshape(-1, 2)
    order = np.lexsort((ahead[:, 1], ahead[:, 0]))  # examples with the same commonest words, as of one language, share blocks: their bounds are tight
    held = [held[i] for i in order]
    y, ids = vecs.column("y").to_numpy().astype(np.int64)[order], vecs.column("doc_id").to_numpy()[order]
    stands_for = np.array([scale[int(v)] for v in y])
    share = stands_for / stands_for.max() if len(y) else none
    base = (float(stands_for @ y) + 0.5) / (float(stands_for.sum()) + 1.0)
    parts = indexed(held, block, len(terms))
    return Index(model.terms, model.gain, stem, label=y, share=share, ids=ids, base=base, k=k, power=power, prior=prior, **parts)


def scores(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted, evidence) for every row of docs.

    evidence lists the nearest examples with cosine and label. Null and empty texts, and those of no known term, have
    no neighbour and score the base rate. Rows that repeat are scored each. An empty table gives no rows; without
    labelled rows every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by per_label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        shape = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
        for b in batches:
            got = [model.score(t) for t in b.column(1).to_pylist()]
            p = [g[0] for g in got]
            found = [[{"doc_id": d, "cosine": c, "label": y} for d, c, y in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), pa.array([int(x >= threshold) for x in p], pa.int32()), pa.array(found, shape)], ["doc_id", "score", "predicted", "evidence"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, "doc_id long, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, label: int>>")


def without_toxic(docs: DataFrame, index: Index, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold, in one map over the table.

    Null and empty texts score the base rate, so they stay where that is below the threshold. Rows that repeat stay or
    go together. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            yield b.filter(pa.array([model.score(t)[0] < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
