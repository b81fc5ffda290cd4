from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import feed

from tessera.streaming import claims

ZERO = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def store(spark):
    for k, v in claims.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in claims.STATE_STORE:
        spark.conf.unset(k)


def in_batches(spark, tmp_path, batches: list[list[dict]], schema: str, op, restart_at: int = -1) -> list:
    """The rows that op gives for batches fed one by one, with a new query on the same checkpoint from each batch on."""
    out, check = os.fspath(tmp_path / "out"), os.fspath(tmp_path / "check")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(os.fspath(tmp_path / "in"))
    for i, b in enumerate(batches):
        feed(tmp_path, f"{i:03d}", b)
        os.utime(tmp_path / "in" / f"{i:03d}", (1_700_000_000 + i, 1_700_000_000 + i))  # files are taken in this order
        if i % 2 == 1 or i == len(batches) - 1:  # two batches to a run, then a restart
            op(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).collect()


def when(seconds: float) -> str:
    return (ZERO + timedelta(seconds=seconds)).isoformat()


def test_claims_equal_a_plain_replay(spark, tmp_path):
    rng = random.Random(4)
    events = [(rng.choice("ab"), rng.choice([None, "", *[f"e{k}" for k in range(9)]]), i) for i in range(120)]
    batches = [[{"scope": s, "id": e, "at": when(i)} for s, e, i in events[k : k + 30]] for k in range(0, 120, 30)]
    got = {(r.scope, r["at"]): r.claimed for r in in_batches(spark, tmp_path, batches, "scope string, id string, at timestamp", lambda s: claims.claims(s, most=4))}
    seen: dict[str, list] = {"a": [], "b": []}
    for s, e, i in events:
        new = not e or e not in seen[s]
        if new and e:
            seen[s] = [*seen[s], e][-4:]
        assert got[s, ZERO + timedelta(seconds=i)] == new
    assert len(got) == 120


def test_pending_requests_equal_a_plain_replay(spark, tmp_path):
    rng = random.Random(6)
    events = [(rng.choice("xy"), rng.choice("pq"), rng.choice(["remember", "consume", "consume", "clear"]), f"m{i}", rng.choice([5, 60, 600]), i * 20) for i in range(100)]
    batches = [[{"chat_id": c, "sender_id": s, "kind": k, "payload": p, "ttl": t, "at": when(at)} for c, s, k, p, t, at in events[n : n + 25]] for n in range(0, 100, 25)]
    schema = "chat_id string, sender_id string, at timestamp, kind string, payload string, ttl double"
    got = {(r.chat_id, r.sender_id, r["at"]): (r.matched, r.payload) for r in in_batches(spark, tmp_path, batches, schema, claims.pending)}
    held: dict = {}
    want = {}
    for c, s, k, p, t, at in events:
        if k == "remember":
            held[c, s] = (p, at + t)
        else:
            p, until = held.pop((c, s), (None, -1))
            if k == "consume":
                want[c, s, ZERO + timedelta(seconds=at)] = (until > at, p if until > at else None)
    assert got == want and any(m for m, _ in want.values()) and not all(m for m, _ in want.values())


def test_conversations_keep_the_last_texts_for_a_while(spark, tmp_path):
    rng = random.Random(7)
    times, at = [], 0
    for _ in range(60):
        at += rng.choice([1, 5, 200])
        times.append(at)
    events = [(rng.choice("xy"), f"t{i}", t) for i, t in enumerate(times)]
    batches = [[{"chat_id": c, "sender_id": "s", "text": x, "at": when(t)} for c, x, t in events[n : n + 15]] for n in range(0, 60, 15)]
    op = lambda s: claims.conversations(s, keep=3, ttl=timedelta(seconds=100)).withColumn("texts", F.array_join("texts", ","))
    got = {(r.chat_id, r["at"]): r.texts for r in in_batches(spark, tmp_path, batches, "chat_id string, sender_id string, at timestamp, text string", op)}
    held: dict = {"x": [], "y": []}
    for c, x, t in events:
        old = [] if held[c] and held[c][-1][1] + 100 <= t else held[c]
        held[c] = [*old, (x, t)][-3:]
        assert got[c, ZERO + timedelta(seconds=t)] == ",".join(v for v, _ in held[c])
