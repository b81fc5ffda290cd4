from __future__ import annotations

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, schema, snapshots
from tessera.sources.remote import PagedTable, Retry, pages


def put(path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return os.fspath(path)


def test_csv(spark, tmp_path):
    path = put(tmp_path / "a.csv", '﻿k,v\n1,"two\nlines"\n2,"say ""hi"""\n3,\n')
    df = files.with_lines(files.read_csv(spark, path))
    assert [(r.k, r.v, r.line) for r in df.orderBy("line").collect()] == [("1", "two\nlines", 2), ("2", 'say "hi"', 3), ("3", None, 4)]
    kind = schema.TableSpec("t", ("k", "v")).struct
    assert files.read_csv(spark, os.fspath(tmp_path / "none.csv"), kind).count() == 0
    wide = put(tmp_path / "b.csv", "k,v\n1,2\n3,4,5\n")
    bad = files.read_csv(spark, wide, kind, corrupt="raw")
    assert [(r.k, r.raw) for r in bad.collect()] == [("1", None), ("3", "3,4,5")]


def test_ledgers(spark, tmp_path):
    a = put(tmp_path / "a.jsonl", '{"h": "1", "v": "first"}\nnot json\n{"h": "", "v": "x"}\n')
    b = put(tmp_path / "b.jsonl", '{"h": "1", "v": "second"}\n{"h": "2", "v": "y"}\n{"h": "", "v": "x"}\n')
    found = files.read_ledger(spark, [a, b, os.fspath(tmp_path / "none.jsonl")], "h string, v string", "h")
    assert sorted((r.h, r.v) for r in found.collect()) == [("", "x"), ("1", "first"), ("2", "y")]
    assert files.read_ledger(spark, os.fspath(tmp_path / "none.jsonl"), "h string").count() == 0


def test_reports_and_trees(spark, tmp_path):
    put(tmp_path / "r" / "a.json", '[{"rule": "x", "n": 1}]')
    put(tmp_path / "r" / "b.json", '{"findings": [{"rule": "y", "n": 2}, {"rule": "z"}]}')
    got = files.read_report(spark, os.fspath(tmp_path / "r"), "rule: string, n: int").collect()
    assert sorted((r.rule, r.n) for r in got) == [("x", 1), ("y", 2), ("z", None)]
    tree = files.read_tree(spark, os.fspath(tmp_path), "*.json")
    assert {r.path.rsplit("/", 1)[1] for r in tree.collect()} == {"a.json", "b.json"}
    one = files.inventory_hash(files.file_inventory(spark, os.fspath(tmp_path))).first()
    put(tmp_path / "r" / "a.json", "[]")
    assert one.files == 2 and files.inventory_hash(files.file_inventory(spark, os.fspath(tmp_path))).first().digest != one.digest


def test_changes_between_trees(spark):
    old = spark.createDataFrame([("a", "1\n2"), ("b", "x"), ("c", "same")], "path string, text string")
    new = spark.createDataFrame([("a", "1\n3\n4"), ("d", "y"), ("c", "same")], "path string, text string")
    assert sorted(map(tuple, files.tree_changes(old, new).collect())) == [("a", "M", 2, 1), ("b", "D", 0, 1), ("d", "A", 1, 0)]
    row = spark.range(1).select(files.path_dims(F.lit("docs/_review/M1/EU/book/intro.rst")).alias("d"), files.path_dims(F.lit("docs/x.rst")).alias("n")).first()
    assert tuple(row.d) == ("M1", "EU", "book", "intro.rst") and tuple(row.n) == ("", "", "", "")


def test_records(spark):
    a = json.dumps({"records": [{"record_id": "r1", "fields": {"k": "v", "n": 1}}]})
    b = json.dumps({"fields": ["k", "n"], "record_id_list": ["r2"], "data": [["w", None]]})
    got = files.decode_records(spark.createDataFrame([(a,), (b,)], "e string"), "e").collect()
    assert {r.record_id: r.fields for r in got} == {"r1": {"k": "v", "n": "1"}, "r2": {"k": "w", "n": "null"}}


def test_markdown(spark):
    doc = "# A\n\n## B\n| x | y |\n|---|:-:|\n| 1 | a\\|b |\n| 2 | c |\n\ntext\n# C\nno | table\n"
    got = [tuple(r) for r in files.markdown_tables(spark.createDataFrame([("d", doc), ("e", None)], "k string, t string"), "k", "t").collect()]
    assert got == [("d", 1, "A > B", 1, "x", "1"), ("d", 1, "A > B", 1, "y", "a|b"), ("d", 1, "A > B", 2, "x", "2"), ("d", 1, "A > B", 2, "y", "c")]


def test_blocks_and_sections(spark):
    doc = "# One\nintro\n## Two\n- item\n### Deep\n| a |\n## Three\n![i](x)\n# Four\nend"
    b = files.blocks(spark.createDataFrame([("d", doc)], "k string, t string"), "k", "t")
    got = [(r.kind, r.text, r.heading_path) for r in b.orderBy("line_no").collect()]
    assert got[:6] == [("heading", "One", "One"), ("paragraph", "intro", "One"), ("heading", "Two", "One > Two"), ("list_item", "- item", "One > Two"), ("heading", "Deep", "One > Two > Deep"), ("table_row", "| a |", "One > Two > Deep")]
    assert got[6:] == [("heading", "Three", "One > Three"), ("image", "![i](x)", "One > Three"), ("heading", "Four", "Four"), ("paragraph", "end", "Four")]
    assert [r.text for r in files.section(b, "two").orderBy("line_no").collect()] == ["Two", "- item", "Deep", "| a |"]


class Server(BaseHTTPRequestHandler):
    total, failures = 450, [429, 503]

    def do_GET(self):
        from urllib.parse import parse_qs, urlparse

        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        if Server.failures:
            self.send_response(Server.failures.pop())
            self.end_headers()
            return
        lo, n = int(q["offset"]), int(q["limit"])
        ids = range(lo, min(lo + n, Server.total))
        body = {"records": [{"record_id": f"r{i}", "fields": {"n": i, "view": q.get("view", "")}} for i in ids], "has_more": lo + n < Server.total} | ({} if "blind" in self.path else {"total": Server.total})
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


@pytest.mark.parametrize("path", ["table", "blind"])
def test_paged_table(spark, path):
    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        Server.failures[:] = [429, 503]
        spark.dataSource.register(PagedTable)
        df = spark.read.format("paged_table").options(url=f"http://127.0.0.1:{server.server_port}/{path}", view="v1", pagesPerPartition="1", retryBase="0.01").load()
        got = df.select("record_id", df.fields["n"].cast("int").alias("n"), df.fields["view"].alias("v")).collect()
        assert sorted(r.n for r in got) == list(range(450)) and {r.v for r in got} == {'"v1"'}
    finally:
        server.shutdown()


def test_pages_and_waits():
    calls = []

    def fetch(offset, limit):
        calls.append((offset, limit))
        return {"records": list(range(offset, min(offset + limit, 5))), "has_more": True}

    assert list(pages(fetch, 0, None, 2)) == [0, 1, 2, 3, 4] and calls[-1] == (5, 2)
    assert [Retry().delay(n) for n in range(6)] == [1, 2, 4, 8, 16, 30] and Retry().delay(0, "7") == 7 and Retry().delay(0, "99") == 30 and Retry().delay(1, "soon") == 2


def test_schema_checks(spark):
    spec = schema.TABLES["variable_defaults"]
    assert schema.TABLES["spec_footnotes"].columns[-1] == "Text_uk" or "Text_ko" in schema.TABLES["spec_footnotes"].columns
    df = spark.createDataFrame([("v", "", "m", "1", "yes"), ("", "k", None, "2", "0")], "Variable_key string, Model_key string, Product string, Value string, is_default string")
    assert schema.header_drift(df, spec) == [("Model", "missing"), ("Product", "extra")]
    assert schema.header_drift(df, spec, other_names={"Model": ["Product"]}) == []
    assert [tuple(r) for r in schema.contract_issues(df, spec).collect()] == [("Variable_key", 1)]
    n = schema.normalised(df, spec, {"Model": ["Product"]})
    assert [tuple(r) for r in n.collect()] == [("v", "", "m", "1", "TRUE"), ("", "k", "", "2", "FALSE")]
    drift = schema.drift_report(spark, {"variable_defaults": df})
    assert drift.where("state = 'missing_table'").count() == len(schema.TABLES) - 1
    assert schema.aliases("jp") == ("jp", "ja") and schema.canonical_language("BR") == "pt-BR" and schema.aliases("xx") == ("xx",)


def test_snapshots(spark, tmp_path):
    root = os.fspath(tmp_path / "snap")
    cols = ", ".join(f"`{c}` string" for c in schema.TABLES["variable_defaults"].columns)
    t1 = spark.createDataFrame([("b", "10", "", "1", ""), ("a", "9", "", "2", ""), ("a", "10", "", "3", "")], cols)
    other = spark.range(3).selectExpr("cast(id as string) as k")
    first = snapshots.publish(spark, {"variable_defaults": t1, "other": other}, root, "csv")
    assert snapshots.current(spark, root) == first
    assert [r.Value for r in files.read_csv(spark, f"{first}/variable_defaults").collect()] == ["2", "3", "1"]
    second = snapshots.publish(spark, {"variable_defaults": t1.orderBy("Value"), "other": other.where("k > 0")}, root)
    assert snapshots.current(spark, root) == second
    got = {r["table"]: (r["row_count"], r["changed"]) for r in spark.read.parquet(f"{second}/_manifest").collect()}
    assert got == {"variable_defaults": (3, False), "other": (2, True)}
    assert sorted(map(tuple, snapshots.inspect(spark, second, ["other", "variable_defaults", "third"]).collect())) == [("other", "ok"), ("third", "missing"), ("variable_defaults", "ok")]


def test_of_two_writers_the_first_to_claim_wins_and_the_other_follows(spark, tmp_path, monkeypatch):
    """One writer stalls between writing its tables and its claim; another publishes in between; nothing is lost or held up."""
    root = os.fspath(tmp_path / "snap")
    one, two = spark.range(3).selectExpr("cast(id as string) as k"), spark.range(5).selectExpr("cast(id as string) as k")
    base = snapshots.publish(spark, {"t": one}, root)
    claim, between = snapshots._claimed, []

    def stalled(spark, pointer, content):
        if not between:
            monkeypatch.setattr(snapshots, "_claimed", claim)
            between.append(snapshots.publish(spark, {"t": two}, root))
            monkeypatch.setattr(snapshots, "_claimed", stalled)
        return claim(spark, pointer, content)

    monkeypatch.setattr(snapshots, "_claimed", stalled)
    late = snapshots.publish(spark, {"t": two}, root)
    assert snapshots.current(spark, root) == late and [n for n, _ in sorted(snapshots._pointers(spark, root))] == [1, 2, 3]
    changed = lambda path: spark.read.parquet(f"{path}/_manifest").first()["changed"]
    assert (changed(base), changed(between[0]), changed(late)) == (True, True, False)  # late is compared with what came in between


def test_a_pointer_that_was_never_finished_does_not_count(spark, tmp_path):
    root = os.fspath(tmp_path / "snap")
    first = snapshots.publish(spark, {"t": spark.range(1)}, root)
    put(tmp_path / "snap" / "CURRENT-000000000002", "")
    assert snapshots.current(spark, root) == first
    third = snapshots.publish(spark, {"t": spark.range(2)}, root)
    assert snapshots.current(spark, root) == third and third != first
    assert not snapshots._claimed(spark, f"{root}/CURRENT-000000000003", "x")


def test_appending_twice_adds_nothing(spark, tmp_path):
    path = os.fspath(tmp_path / "ledger")
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("", 3), (None, 4)], "k string, v int")
    for _ in range(2):
        snapshots.append_new(rows, path, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2)]
    snapshots.backup(rows, os.fspath(tmp_path / "backup"))
    assert snapshots.differences(rows, snapshots.restore(spark, os.fspath(tmp_path / "backup"))).count() == 0
    assert snapshots.differences(rows, rows.where("v <> 2")).collect()[0].side == "a"


def test_language_blocks_and_capability_sections(spark):
    page = "intro\n**FRAGILE** stays with en\n**FR IMPORTANT**\nbonjour\n**DE WICHTIG**\nhallo"
    docs = spark.createDataFrame([("p", page), ("q", None)], "k string, t string")
    assert {r.key: r.t for r in files.in_languages(docs, "k", "t", ["en", "de"]).collect()} == {"p": "intro\n**FRAGILE** stays with en\n**DE WICHTIG**\nhallo", "q": ""}
    assert {r.key: r.t for r in files.in_languages(docs, "k", "t", ["fr"]).collect()} == {"p": "**FR IMPORTANT**\nbonjour", "q": ""}
    text = "a\n.. begin-capability: wifi\nb\n.. end-capability: wifi\nc\n.. begin-capability: solar\nd\n.. end-capability: solar"
    docs = spark.createDataFrame([("p", text), ("q", text)], "k string, t string")
    lacking = spark.createDataFrame([("p", "wifi")], "key string, capability string")
    assert {r.key: r.t for r in files.without_sections(docs, "k", "t", lacking).collect()} == {"p": "a\nc\nd", "q": "a\nb\nc\nd"}


def test_field_entries(spark):
    page = "Power\n=====\n:Input: 5 V\n:Input: 9 V\n:Empty:\n\nSize\n----\n* - Width\n  - 10 cm\n"
    got = files.field_entries(spark.createDataFrame([("p", page)], "k string, t string"), "k", "t").orderBy("pos").collect()
    assert [(r.section, r.shown, r.value) for r in got] == [("Power", "Input", "5 V"), ("Power", "Input #2", "9 V"), ("Size", "Width", "10 cm")]


def test_sections_go_through_no_join(spark):
    """However small the pages' file is planned to be: no row a document is sent to the driver. A page in parts of equal lines, one without the title, and a null key."""
    page = "# One\n\n## Two\ntext\n### Deep\n## Two\nlast"
    docs = spark.createDataFrame([("a", page), ("b", "# Other\nx"), ("c", "two\n# TWO \ny"), (None, page)], "k string, t string")
    found = files.section(files.blocks(docs, "k", "t"), "two")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.key, r.line_no) for r in found.orderBy("key", "line_no").collect()] == [("a", 2), ("a", 3), ("a", 4), ("c", 1), ("c", 2)]
