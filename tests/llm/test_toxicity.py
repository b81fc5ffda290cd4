from __future__ import annotations

import zlib

import numpy as np

from tessera.llm import toxicity
from tessera.llm.common import table

SF = "/root/testdata/sf0.1"


def dense_score(index: toxicity.Index, examples: np.ndarray, text: str | None) -> float:
    """The score by its definition: cosines with all examples, no index."""
    q = np.zeros(len(index.terms))
    at, w = index.vector(text)
    q[at] = w
    if not len(at):
        return index.base
    cosine = examples @ q
    top = np.lexsort((np.arange(len(cosine)), -np.round(cosine, 12)))[: index.k]
    top = top[cosine[top] > 0]
    vote = (cosine[top] / cosine[top].max()) ** index.power * index.share[top]
    return float((vote @ index.label[top] + index.prior * index.base) / (vote.sum() + index.prior))


def test_scores_brute_force(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    index = toxicity.fit(docs, labels, block=16)
    rows = docs.collect()
    texts: dict[int, str] = {r.doc_id: r.text for r in rows}
    examples = np.zeros((len(index.ids), len(index.terms)))
    for i, d in enumerate(index.ids.tolist()):
        at, w = index.vector(texts[d])
        examples[i, at] = w
    found = toxicity.scores(docs, index).collect()
    assert len(found) == len(rows)
    for r in found:
        assert abs(r.score - dense_score(index, examples, texts[r.doc_id])) < 1e-6 and r.predicted == int(r.score >= 0.3)
    assert sum(not r.evidence for r in found) <= sum(not toxicity.stems(t, 5) for t in texts.values()) + 5  # only texts of no known word lack neighbours


def test_nearest_are_exact():
    rng = np.random.default_rng(0)
    n, v = 300, 40
    dense = rng.random((n, v)) * (rng.random((n, v)) < 0.2)
    dense = dense[dense.sum(axis=1) > 0]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    parts = toxicity.indexed([(np.flatnonzero(x), x[x > 0]) for x in dense], 16, v)
    index = toxicity.Index({str(i): i for i in range(v)}, np.ones(v), 5, label=np.zeros(len(dense)), share=np.ones(len(dense)), ids=np.arange(len(dense)), base=0.1, k=5, power=2.0, prior=0.3, **parts)
    for _ in range(50):
        at = np.sort(rng.choice(v, rng.integers(1, 12), replace=False))
        w = rng.random(len(at))
        found, cosine = index.nearest(at, w)
        full = dense[:, at] @ w
        want = np.sort(full)[::-1][:5]
        assert np.allclose(cosine, want[want > 0]) and np.allclose(full[found], cosine)


def test_held_out_accuracy_and_calibration(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = toxicity.scores(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("pmod(crc32(cast(doc_id as string)), 4) = 2")
    rows = found.select("score", "predicted", "toxic").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    clean = [r for r in rows if r.toxic == 0]
    assert hit >= 0.93 * sum(r.toxic for r in rows) and sum(r.predicted for r in clean) <= 0.05 * len(clean)  # from 329 examples of label 1; 2,000 do better
    assert sum((r.score - r.toxic) ** 2 for r in rows) / len(rows) < 0.03
    assert abs(sum(r.score for r in rows) - sum(r.toxic for r in rows)) < 0.03 * len(rows)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 4) = 2 then 1 - toxic else toxic end as toxic")
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.scores(docs, toxicity.fit(docs, x)).collect()) for x in (labels, turned))
    assert a == b


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i // 3, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    rows, scale = toxicity.sample(docs, labels, 4)
    train = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert rows.count() == 8 and rows.select("doc_id").distinct().count() == 8
    assert scale == {y: sum(i % 2 == y for i in train) / 4 for y in (0, 1)}


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None), (1, 1, 1), (5, 0, 7)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.where("false")):
        index = toxicity.fit(odd_docs, lab)
        rows = toxicity.scores(odd_docs, index).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert all(r.score == index.base and not r.evidence for r in rows if r.doc_id in (3, 4, 5))
        assert toxicity.scores(no_docs, index).count() == 0 and toxicity.without_toxic(no_docs, index).count() == 0
        assert toxicity.without_toxic(odd_docs, index, threshold=1.1).count() == odd_docs.count()
    assert index.base == 0.5


def test_copies_do_not_teach_their_words(spark):
    """A word in many settings leans; the words of a text of which label 1 has many near copies hardly do."""
    rng = np.random.default_rng(1)
    plain = lambda: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(12))
    ones = [f"{plain()} zzqqx {plain()}" for _ in range(80)] + [f"{plain()} {i} copied uvwuv words kept here" for i in range(400)]
    zeros = [plain() for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ones + zeros)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i < len(ones))) for i in range(len(ones + zeros))], "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, labels)
    assert index.gain[index.terms["zzqqx"]] > 5 * index.gain[index.terms["uvwuv"]]
