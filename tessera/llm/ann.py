"""Approximate nearest neighbours by a permutation index.

A sample of vectors serves as pivots: `spread` x sqrt(N) of N vectors, at most `most_pivots`. Every vector is
represented by its pivots in order of nearness (its permutation, cut to a prefix) and posted in the inverted files of
its nearest few pivots. A query reads the files of more of its own nearest pivots, ranks what it finds there by
footrule distance between permutations (a pivot missing from a prefix counts as standing at its end), and reranks the
best part of it by cosine on the original vectors in double precision. How many files a query reads follows from the recall that is
asked for: it is measured on a bounded number of queries, whose true neighbours one pass over all vectors finds.

A pivot's file can hold a third of all vectors (many copies of one), and so can its readers: files are cut
into shards of `file_rows` vectors by `query_rows` queries, each a task group of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map, written


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v binary of doubles): vectors that take part, one row per id (the least of its vectors).

    Null ids and vectors, zero vectors and those with a null or non-finite component take no part; of vectors of
    different lengths, only those of the commonest (then the shorter) length do.
    """
    as_double = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    fine = as_double.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    one = fine.groupBy("id").agg(F.min("v").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in np.split(flat, ends[:-1])] if b.num_rows else [], pa.binary())], ["id", "v"])

    packed = written(arrow_map(one, run, "id long, v binary"))
    common = packed.groupBy(F.length("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return packed.where(F.length("v") == (common["n"] if common else 0))


def _matrix(column: pd.Series | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.tolist()), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row of x, the same number for the same vector wherever it stands.

    Vectors are scaled by a power of two to a largest component between a half and one: exact, and no square leaves the range of doubles.
    """
    x, q = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=-1, keepdims=True))[1]) for v in (x, q))
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _permutations(packed: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """(id, v, perm array<int>): each vector with its nearest pivots in order, ties to the smaller number."""
    shared = packed.sparkSession.sparkContext.broadcast(pivots)  # at most most_pivots vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                sims = _unit(_matrix(part.column(1).to_pandas())) @ shared.value.T
                perm = np.argsort(-sims, axis=1, kind="stable")[:, :prefix].astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(perm), pa.list_(pa.int32()))], ["id", "v", "perm"])

    return arrow_map(packed, run, "id long, v binary, perm array<int>")


def footrule(perms: np.ndarray, query: np.ndarray, n_pivots: int) -> np.ndarray:
    """Sum over all pivots of the difference in place between each of perms and query; past a prefix all stand at its end."""
    prefix = perms.shape[1]
    place = np.full(n_pivots, prefix, np.int32)
    place[query] = np.arange(prefix, dtype=np.int32)
    there = place[perms]
    return (np.abs(np.arange(prefix, dtype=np.int32) - there) + there).sum(axis=1, dtype=np.int64) + prefix * (prefix + 1) // 2 - prefix * prefix


def _rerank(found: pd.DataFrame, asked: pd.DataFrame, n_pivots: int, share: float, k: int) -> pd.DataFrame:
    """The k nearest (query, vec, score) in one file shard for each of its readers."""
    out: list[tuple[int, int, float]] = []
    if len(found) and len(asked):
        x, q = _matrix(found["v"]), _matrix(asked["qv"])
        unit, perms = _unit(x), np.stack(found["perm"].tolist())
        ids, keep = found["id"].to_numpy(), max(k + 1, 64, int(np.ceil(share * len(x))))
        for i, (query, perm) in enumerate(zip(asked["qid"].tolist(), asked["qperm"], strict=True)):
            near = np.arange(len(x))
            if keep < len(x):
                foot = footrule(perms, perm, n_pivots)
                near = np.flatnonzero(foot <= np.partition(foot, keep - 1)[keep - 1])
            near = near[ids[near] != query]
            if len(near) > 4 * k:  # the exact measure is taken where it can matter
                rough = unit[near] @ _unit(q[i : i + 1])[0]
                near = near[rough >= np.partition(rough, -k)[-k] - 1e-9]
            if len(near):
                exact = cosines(q[i], x[near])
                top = np.lexsort((ids[near], -exact))[:k]
                out += zip([query] * len(top), ids[near][top].tolist(), exact[top].tolist(), strict=True)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def needed_reads(index: DataFrame, is_query: str, pivots: np.ndarray, posts: int, k: int, target: float, probes: int) -> int:
    """How many files a query has to read so that the share `target` of nearest neighbours stands in one of them.

    Measured on at most `probes` queries, those of least id hash, by an exact pass over all vectors: each task keeps its k nearest a
    probe. Without queries or neighbours, one file.
    """
    asked = index.where(is_query).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(probes).select("id", "v").collect()  # at most probes rows
    if not asked:
        return 1
    ids, units = np.array([r["id"] for r in asked]), _unit(np.stack([np.frombuffer(bytes(r["v"]), np.float64) for r in asked]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = []
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                own = part.column(0).to_numpy()
                sims = _unit(_matrix(part.column(1).to_pandas())) @ units.T
                sims[own[:, None] == ids[None, :]] = -np.inf
                top = np.argsort(-sims, axis=0, kind="stable")[:k]
                files = part.column(2).to_pylist()
                best += [(q, float(sims[r, q]), int(own[r]), files[r]) for rows in top for q, r in enumerate(rows) if np.isfinite(sims[r, q])]
            best.sort(key=lambda x: (x[0], -x[1], x[2]))
            best = [x for i, x in enumerate(best) if i < k or best[i - k][0] != x[0]]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*best, strict=True)], ["q", "s", "id", "files"])

    near = arrow_map(index.select("id", "v", F.slice("perm", 1, posts).alias("files")), run, "q long, s double, id long, files array<long>")
    order = W.partitionBy("q").orderBy(F.desc("s"), "id")
    rows = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "files").collect()  # at most k rows a probe
    place = np.argsort(np.argsort(-(units @ pivots.T), axis=1, kind="stable"), axis=1)
    need = sorted(int(place[r["q"], r["files"]].min()) + 1 for r in rows)
    return need[min(len(need) - 1, int(np.ceil(target * len(need))))] if need else 1


def search(
    vectors: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", spread: float = 2.0, most_pivots: int = 1 << 16, prefix: int = 96,
    posts: int = 4, target: float = 0.98, probes: int = 256, reach: float | None = None, share: float = 0.2, file_rows: int = 8192, query_rows: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every vector whose id satisfies is_query (SQL on id).

    Pivots are the vectors with the least id hash. How many files a query reads is measured: as many as hold the share `target` of the
    true neighbours of `probes` queries; reach sets it to reach x sqrt(pivots) instead. target = 1 is the exact way: all files are read and all vectors in them compared. Ties go to the
    smaller vec_id. A query that found fewer than k, with more to find, reads all files. No vectors, or a single one, give no rows.
    """
    packed = usable(vectors, id_col, vector_col)
    total = packed.count()
    chosen = packed.orderBy(F.xxhash64("id"), "id").limit(max(16, min(most_pivots, round(spread * total**0.5)))).collect()  # at most most_pivots rows
    pivots = _unit(np.stack([np.frombuffer(bytes(r["v"]), np.float64) for r in chosen])) if chosen else np.zeros((0, 1))
    n, cut = len(pivots), min(prefix, len(pivots))
    index = written(_permutations(packed, pivots, cut))
    if target >= 1:
        reads, share = n, 1.0
    elif reach is not None:
        reads = min(n, max(1, round(reach * n**0.5)))
    else:
        reads = min(n, needed_reads(index, is_query, pivots, min(posts, cut), k, target, probes)) if n else 0

    def read(queries: DataFrame, reads: int, share: float) -> DataFrame:
        file = index.select("id", "v", "perm", F.explode(F.slice("perm", 1, posts)).alias("pivot"))
        if reads >= n:  # all files: each vector needs to stand in one only
            file = index.select("id", "v", "perm", F.col("perm")[0].alias("pivot"))
            asked = queries.select("qid", "qv", "qperm", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("pivot"))
        else:
            asked = queries.select("qid", "qv", "qperm", F.explode(F.slice("qfiles", 1, reads)).alias("pivot"))
        shards = lambda df, rows, name: df.groupBy("pivot").agg(F.ceil(F.count("*") / rows).cast("int").alias(name))
        grid = F.broadcast(shards(file, file_rows, "a").join(shards(asked, query_rows, "b"), "pivot"))  # a row per pivot
        left = file.join(grid, "pivot").select("id", "v", "perm", "pivot", F.pmod(F.xxhash64("id"), "a").alias("s"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("t"))
        right = asked.join(grid, "pivot").select("qid", "qv", "qperm", "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("a").cast("long") - 1)).alias("s"), F.pmod(F.xxhash64("qid"), "b").cast("int").alias("t"))
        keys = ["pivot", "s", "t"]
        run = lambda l, r: _rerank(l, r, n, share, k)  # noqa: E731, E741
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(run, "query_id long, vec_id long, score double").distinct()

    asked = _permutations(packed.where(is_query), pivots, max(cut, reads))  # a query's order of files may have to go on past the prefix
    queries = written(asked.select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.slice("perm", 1, cut).alias("qperm"), F.col("perm").alias("qfiles")))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    found = written(top(read(queries, reads, share)))
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select(F.col("query_id").alias("qid"))
    short = written(queries.join(enough, "qid", "left_anti"))
    if total > 1 and not short.isEmpty():
        found = found.join(short.select(F.col("qid").alias("query_id")), "query_id", "left_anti").unionByName(top(read(short, n, 1.0)))
    return found
