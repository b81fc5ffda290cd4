from __future__ import annotations

import json
import os
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tessera.streaming import events


def feed(tmp_path, name: str, lines: list) -> None:
    path = tmp_path / "in"
    path.mkdir(exist_ok=True)
    hidden = tmp_path / name
    hidden.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    os.rename(hidden, path / name)


def change(event_id, value="true", action="record_edited", table="tbl", field="now"):
    return {"header": {"event_id": event_id, "event_type": "changed"}, "event": {"file_token": "base", "file_type": "table", "table_id": table, "action_list": [{"action": action, "after_value": [{"field_id": field, "field_value": value}]}]}}


def test_events_that_ask_for_a_build(spark):
    lines = [change("1"), change("2", "[\"Yes\"]"), change("3", "0"), change("4", "false"), change("5", table="other"), change("6", action="record_deleted"), change("7", field="later"), "no json", {"header": None}, "[]", change("8", "2"), {"header": {"event_id": "9", "event_type": "changed"}, "event": {"file_token": "base", "file_type": "table", "table_id": "tbl"}}]
    df = spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string")
    asked = events.parsed(df).where(events.asks_for_build("changed", "table", "base", "tbl", "now"))
    assert sorted(r.header.event_id for r in asked.collect()) == ["1", "2", "8"]
    assert events.parsed(df).count() == 10


def run(spark, stream, mode="append"):
    name = f"t_{uuid.uuid4().hex}"
    stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_repeats_go_and_events_without_an_id_stay(spark, tmp_path):
    feed(tmp_path, "1", [{"id": "a", "at": "2024-01-01T00:00:00"}, {"id": "a", "at": "2024-01-01T00:00:05"}, {"at": "2024-01-01T00:00:01"}, {"at": "2024-01-01T00:00:02"}, {"id": "b", "at": "2024-01-01T00:01:00"}])
    stream = spark.readStream.schema("id string, at timestamp").json(os.fspath(tmp_path / "in"))
    assert sorted(str(r.id) for r in run(spark, events.deduplicated(stream, "id", "at"))) == ["None", "None", "a", "b"]
    table = spark.read.schema("id string, at timestamp").json(os.fspath(tmp_path / "in"))
    assert sorted(str(r.id) for r in events.deduplicated(table, "id", "at").collect()) == ["None", "None", "a", "b"]


def test_one_run_for_each_batch_with_rows(spark, tmp_path):
    feed(tmp_path, "1", [{"id": "a"}, {"id": "b"}])
    stream = spark.readStream.schema("id string").json(os.fspath(tmp_path / "in"))
    runs: list[list[str]] = []
    check = os.fspath(tmp_path / "check")
    build = lambda batch, number: runs.append(sorted(r.id for r in batch.collect()))
    events.on_batch(stream, build, check, once=True).awaitTermination()
    feed(tmp_path, "2", [{"id": "c"}])
    events.on_batch(stream, build, check, once=True).awaitTermination()
    events.on_batch(stream, build, check, once=True).awaitTermination()
    assert runs == [["a", "b"], ["c"]]


def test_leases(spark, tmp_path):
    rows = [("r", "t1", "00:00:00"), ("r", "t2", "01:00:00"), ("r", "t1", "01:30:00"), ("r", "t2", "03:29:59"), ("r", "t2", "03:30:00"), ("s", "t2", "00:30:00")]
    feed(tmp_path, "1", [{"record_id": k, "token": t, "at": f"2024-01-01T{at}"} for k, t, at in rows])
    stream = spark.readStream.schema("record_id string, token string, at timestamp").json(os.fspath(tmp_path / "in"))
    got = sorted((r.record_id, r["at"], r.token, r.granted) for r in run(spark, events.leases(stream)))
    assert [(k, t, g) for k, _, t, g in got] == [("r", "t1", True), ("r", "t2", False), ("r", "t1", True), ("r", "t2", False), ("r", "t2", True), ("s", "t2", True)]


def test_contexts_keep_the_last_messages(spark, tmp_path):
    feed(tmp_path, "1", [{"conversation": "c", "at": f"2024-01-01T00:00:0{i}", "text": f"m{i}"} for i in range(5)] + [{"conversation": "d", "at": "2024-01-01T00:00:00", "text": None}])
    stream = spark.readStream.schema("conversation string, at timestamp, text string").json(os.fspath(tmp_path / "in"))
    got = {r.conversation: (r["at"], r.events) for r in run(spark, events.contexts(stream, keep=3))}
    assert got == {"c": (datetime(2024, 1, 1, 0, 0, 4), "m2\nm3\nm4"), "d": (datetime(2024, 1, 1), "")}


def test_true_fields(spark):
    values = ["true", "1", "2.5", "0", "0.0", "no", "", None, '["false", "true"]', '"Y"']
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    assert [r.x for r in df.select(events.field_is_true(F.col("v")).alias("x")).orderBy("i").collect()] == [True, True, True, False, False, False, False, False, True, True]
