from __future__ import annotations

import json
import os
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tessera.sources import live, remote, writeback
from tessera.streaming import events


class Server:
    """A table of records with revisions and a log of events, and what was asked of it."""

    def __init__(self):
        self.records, self.log, self.lock = {}, [], threading.Lock()
        self.served, self.writes, self.busy, self.stale, self.deaf, self.broken = 0, [], set(), set(), set(), set()
        owner = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *args):
                pass

            def answer(self, code, body):
                data = json.dumps(body).encode()
                self.send_response(code)
                self.send_header("Content-Length", str(len(data)))
                self.send_header("Retry-After", "0")
                self.end_headers()
                self.wfile.write(data)

            def do_GET(self):  # noqa: N802
                url = urllib.parse.urlparse(self.path)
                q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
                with owner.lock:
                    if url.path == "/log":
                        a, n = int(q["from"]), int(q["limit"])
                        return self.answer(200, {"events": owner.log[a : a + n], "next": len(owner.log)})
                    if url.path == "/records":
                        want = json.loads(q.get("filter", "{}"))
                        rows = [{"record_id": k, "fields": v["fields"]} for k, v in owner.records.items() if all(str(v["fields"].get(f, "")).lower() == x.lower() for f, x in want.items())]
                        a, n = int(q["offset"]), int(q["limit"])
                        owner.served += len(rows[a : a + n])
                        return self.answer(200, {"records": rows[a : a + n], "total": len(rows), "has_more": a + n < len(rows)})
                    name = urllib.parse.unquote(url.path.rsplit("/", 1)[1])
                    if name in owner.broken or name not in owner.records:
                        return self.answer(404, {})
                    return self.answer(200, owner.records[name])

            def do_PATCH(self):  # noqa: N802
                name = urllib.parse.unquote(self.path.rsplit("/", 1)[1])
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                with owner.lock:
                    r = owner.records[name]
                    if name in owner.busy:
                        owner.busy.discard(name)
                        return self.answer(429, {})
                    if name in owner.stale:  # somebody writes another field in between
                        owner.stale.discard(name)
                        r["revision"] += 1
                    if body["revision"] != r["revision"]:
                        return self.answer(409, {})
                    if name not in owner.deaf:
                        r["fields"].update(body["fields"])
                        r["revision"] += 1
                    owner.writes.append(name)
                    return self.answer(200, r)

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.http.server_address[1]}"
        threading.Thread(target=self.http.serve_forever, daemon=True).start()


@pytest.fixture
def server():
    s = Server()
    yield s
    s.http.shutdown()


def test_equality_filters_reach_the_server_and_the_rest_stays(spark, server):
    server.records = {f"r{i:03d}": {"fields": {"Lang": ("EN", "en", "fr")[i % 3], "n": i}, "revision": 0} for i in range(300)}
    spark.dataSource.register(remote.PagedTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = spark.read.format("paged_table").options(url=f"{server.url}/records", columns="Lang, n", pageSize="20", pagesPerPartition="2").load()
        got = rows.where("Lang = 'en' and cast(n as int) > 250").collect()
        assert sorted(int(r.n) for r in got) == [i for i in range(251, 300) if i % 3 == 1]  # the server took EN for en, Spark did not
        assert server.served <= 201
        server.served = 0
        assert rows.where("Lang in ('EN', 'fr')").count() == 200 and server.served >= 300
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_cells_are_written_once_checked_and_read_back(spark, server, tmp_path):
    names = ["plain", "already", "drift", "busy", "stale", "deaf", "any", "odd/id ä"]
    server.records = {n: {"fields": {"f": "done" if n == "already" else "other" if n == "drift" else "old"}, "revision": 3} for n in names}
    server.busy, server.stale, server.deaf, server.broken = {"busy"}, {"stale"}, {"deaf"}, {"broken"}
    rows = [(n, "f", None if n == "any" else "old", "done") for n in names] + [("broken", "f", "old", "done"), (None, "f", "old", "done"), ("plain", "g", None, " new ")]
    df = spark.createDataFrame(rows, "record_id string, field string, expected string, value string")
    out = os.fspath(tmp_path / "out")
    got = {(r.record_id, r.field): r.status for r in writeback.write_cells(df, f"{server.url}/records", out, tasks=3, retryBase="0.01").collect()}
    assert got == {("plain", "f"): "written", ("plain", "g"): "written", ("already", "f"): "already_applied", ("drift", "f"): "drift_abstained", ("busy", "f"): "written", ("stale", "f"): "written", ("deaf", "f"): "verify_failed", ("any", "f"): "written", ("odd/id ä", "f"): "written", ("broken", "f"): "error", (None, "f"): "error"}
    assert server.records["drift"]["fields"]["f"] == "other" and server.records["odd/id ä"]["fields"]["f"] == "done"
    server.deaf = set()
    again = {r.status for r in writeback.write_cells(df.where("record_id not in ('drift', 'broken', 'deaf')"), f"{server.url}/records", os.fspath(tmp_path / "again"), retryBase="0.01").collect()}
    assert again == {"already_applied"} and sorted(server.writes) == sorted(["plain", "plain", "busy", "stale", "any", "deaf", "odd/id ä"])


def test_a_task_that_runs_again_writes_nothing_twice(server, tmp_path):
    """The same rows through two attempts of a task, of which the second counts."""
    server.records = {f"r{i}": {"fields": {"f": "old"}, "revision": 0} for i in range(5)}
    from pyspark.sql import Row

    rows = [Row(record_id=f"r{i}", field="f", expected="old", value="new") for i in range(5)]
    writer = writeback.CellWriter({"url": f"{server.url}/records", "outcomes": os.fspath(tmp_path), "retryBase": "0.01"})
    lost, kept = writer.write(iter(rows)), writer.write(iter(rows))
    assert lost.counts == {"written": 5} and kept.counts == {"already_applied": 5} and len(server.writes) == 5
    writer.commit([kept, None])
    named = [json.loads(p.read_text()) for p in tmp_path.glob("commit-*")]
    assert named == [{"files": [kept.file], "counts": {"already_applied": 5}}]
    writer.abort([lost])
    assert not (tmp_path / lost.file).exists() and (tmp_path / kept.file).exists()


def test_no_outcomes_of_no_rows(spark, server, tmp_path):
    df = spark.createDataFrame([], "record_id string, field string, expected string, value string")
    assert writeback.write_cells(df, f"{server.url}/records", os.fspath(tmp_path)).count() == 0


def test_a_live_log_restarts_without_loss_or_repeat(spark, server, tmp_path):
    line = lambda i: json.dumps({"header": {"event_id": str(i), "event_type": "changed"}}) if i % 10 else "no json"
    server.log = [line(i) for i in range(95)]
    spark.dataSource.register(live.EventLog)
    out, check = os.fspath(tmp_path / "out"), os.fspath(tmp_path / "check")
    stream = spark.readStream.format("event_log").options(url=f"{server.url}/log", pageSize="7", eventsPerPartition="30", retryBase="0.01").load()
    crash = {"at": 1}

    def sink(batch, number):  # noqa: ANN001
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if number == crash["at"]:
            crash["at"] = -1
            raise RuntimeError("the driver is lost after it wrote, before it committed")

    def run(until_error=False):
        q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", check).start()
        try:
            q.processAllAvailable()
        except Exception:
            if not until_error:
                raise
        q.stop()

    run()
    server.log += [line(i) for i in range(95, 160)]
    run(until_error=True)
    server.log += [line(i) for i in range(160, 170)]
    run()
    rows = spark.read.parquet(out)
    assert sorted(r.seq for r in rows.collect()) == list(range(170))
    assert events.parsed(rows.select("value")).count() == 153
    assert rows.select(F.countDistinct("batch")).first()[0] == 3


def test_a_log_that_lost_events_is_an_error(server):
    server.log = ["a"] * 10
    reader = live.EventLogReader({"url": f"{server.url}/log", "retryBase": "0.01"})
    assert [p.stop for p in reader.partitions({"next": 0}, {"next": 4500})] == [2000, 4000, 4500]
    assert len(list(reader.read(live.Span(3, 10)))) == 7
    with pytest.raises(ValueError, match="lacks"):
        list(reader.read(live.Span(8, 12)))
