"""Branches that the supplied tables do not reach: conflicts, ambiguity, ties, repeats, nothing at all."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import diff, lookup, metrics, quality, queue, search


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted((tuple(r) for r in df.collect()), key=str)


def test_translation_conflicts_raise_if_asked(spark):
    memory = spark.createDataFrame([("a ", "x", None), ("a", " x", "y"), ("b", "1", "2"), ("b", "1", "3"), ("", "z", "z")], "en string, fr string, de string")
    index = lookup.translation_index(memory, "en", ["fr", "de"])
    assert rows(index) == [("a", "de", "y", False), ("a", "fr", "x", False), ("b", "de", None, True), ("b", "fr", "1", False)]
    with pytest.raises(PySparkException, match="two translations"):
        lookup.strict(index, F.col("conflict"), "two translations").collect()


def test_one_id_twice_is_unique_two_ids_are_not(spark):
    df = spark.createDataFrame([("a", "r1"), ("a", "r1"), ("b", "r1"), ("b", "r2"), ("", "r3"), ("c", None)], "k string, r string")
    assert rows(lookup.unique_or_abstain(df, ["k"], "r")) == [("a", "r1", "unique"), ("b", None, "ambiguous")]
    assert rows(lookup.value_index(df, "k", ["r"]))[0] == ("a", None, "ambiguous")


def test_containment_by_characters_agrees(spark):
    hay = spark.createDataFrame([(1, "the quick brown fox"), (2, "ab"), (3, None), (4, "quick brown foxes quick"), (4, "quick brown foxes quick")], "id int, t string")
    needles = spark.createDataFrame([("n1", "quick brown fox"), ("n2", "ab"), ("n3", ""), ("n4", "zzz"), ("n5", "fox")], "n string, v string")
    a = rows(lookup.containment(hay, "t", needles, "n", "v").select("id", "n"))
    assert a == rows(lookup.containment(hay, "t", needles, "n", "v", most_bytes=0).select("id", "n")) == [(1, "n1"), (1, "n5"), (2, "n2"), (4, "n1"), (4, "n1"), (4, "n5"), (4, "n5")]


def test_variables(spark):
    defaults = spark.createDataFrame([("v", ["A"], "1", False), ("v", [], "0", True), ("w", [], "5", True), ("w", [], "6", True)], "variable string, models array<string>, value string, is_default boolean")
    asked = spark.createDataFrame([(1, "v", "a", "fr"), (2, "v", "B", "fr"), (3, "w", "B", "fr"), (4, "q", "B", "fr")], "request_id int, variable string, model string, lang string")
    overrides = spark.createDataFrame([("v", "fr", "0", "zéro")], "variable string, lang string, source_value string, value string")
    assert rows(lookup.variable_values(defaults, asked, overrides)) == [(1, "v", "1", "found"), (2, "v", "zéro", "found"), (3, "w", None, "duplicate"), (4, "q", None, "missing")]


def test_a_blank_copy_text_spoils_the_key(spark):
    copy = spark.createDataFrame([("k", "", "", "", "", "fine", 2), ("k", "EU", "", "", "", " ", 3), ("m", "US", "", "", "", "us", 4)], "copy_key string, region string, model string, is_latest string, version string, text string, line int")
    asked = spark.createDataFrame([(1, "k", "M", "EU"), (2, "k", "M", "US"), (3, "m", "M", "EU")], "request_id int, copy_key string, model string, region string")
    assert rows(lookup.copy_texts(copy, asked)) == [(1, None, None, "blank"), (2, "fine", 2, "found"), (3, None, None, "missing")]


def test_footnotes(spark):
    notes = spark.createDataFrame(
        [("f1", "", "EU", "", "en", "9", ""), ("f2", "p", "US", "", "en", "10", ""), ("f2", "p", "US", "", "en", "9", ""), ("f3", "p", "", "M1", "en", "1", ""), ("f3", "p", "US", "", "en", "2", ""), ("f4", "p", "US", "", "en", "3", ""), ("f4", "p", "US", "", "en", "3", ""), ("f5", "p", "US", "M2", "en", "4", ""), ("f6", "p", "US", "", "en", "5", "no")],
        "footnote_id string, page string, region string, model string, source_lang string, line string, is_latest string",
    )
    refs = spark.createDataFrame([("p", f"f{i}") for i in range(1, 7)], "page string, footnote_id string")
    got = [(r.footnote_id, r.line, r.how) for r in lookup.footnotes(notes, refs, "M1", "EU", ["en"]).collect()]
    assert sorted(got) == [("f1", "9", "exact"), ("f2", "10", "fallback"), ("f3", "1", "exact")]


def test_narrowing_stops_where_it_would_leave_nothing(spark):
    snapshot = spark.createDataFrame([("a", 1, "1", "s", "v"), ("a", 2, "2", "t", "v"), ("b", 3, "9", "s", "old")], "k string, rid int, line string, section string, value string")
    wanted = spark.createDataFrame([(1, "a", "2", "zzz", "v"), (2, "a", "7", "zzz", "v"), (3, "b", "1", "s", "new"), (4, "c", "1", "s", "x"), (5, "a", "7", "s", "v")], "candidate_id int, k string, line string, section string, value string")
    got = rows(lookup.candidate_actions(wanted, snapshot, ["k"], ["line", "section"], ["value"], "rid"), "candidate_id")
    assert got == [(1, "noop", 2, ""), (2, "review", None, None), (3, "update", 3, "value"), (4, "create", None, None), (5, "noop", 1, "")]


def test_latest_documents_keys(spark):
    cols = "document_key string, document_id string, record_id string, version string, delivery_ready boolean, delivery_url string, result string, pos int"
    data = [("", "M_EU_v1.9", "r1", "", True, "u", "success", 1), ("", "M_EU_v1.10", "r2", "", False, "", "", 2), ("", "M_v1", "r3", "", None, None, None, 3), ("K", "x", "r4", "1", False, "", "", 4), ("K", "y", "r5", "1", False, "u", "", 5), ("K", "z", "r6", "1", False, "u", "", 6), (None, None, "r7", None, None, None, None, 7)]
    got = lookup.latest_documents(spark.createDataFrame(data, cols))
    assert rows(got.select("latest_key", "record_id", "first_pos")) == [("K", "r5", 4), ("M_EU", "r2", 1), ("M_v1", "r3", 3), ("r7", "r7", 7)]


def test_keyed_diff_passes(spark):
    cols = "page string, k string, s string, v string, pos int"
    old = spark.createDataFrame([("p", "a", "", "1", 1), ("p", "a", "", "2", 2), ("p", "b", "r1", "3", 3), ("p", "c", "", "4", 4), ("q", "x", "", "5", 1), ("q", "y", "", "6", 2)], cols)
    new = spark.createDataFrame([("p", "a", "", "1", 1), ("p", "a", "", "9", 2), ("p", "B", "r1", "3", 3), ("p", "d", "", "4", 4), ("q", "z", "", "5", 1)], cols)
    got = rows(diff.keyed_diff(old, new, ["page"], "k", "s", "v"))
    assert got == [("p", "M", "a", "2", "9", "key"), ("p", "M", "b -> B", "3", "3", "source"), ("p", "M", "c -> d", "4", "4", "position"), ("q", "A", "z", None, "5", "left"), ("q", "D", "x", "5", None, "left"), ("q", "D", "y", "6", None, "left")]


def test_block_diff_pairs_replaced_runs(spark):
    old = spark.createDataFrame([("d", i, t) for i, t in enumerate(["h", "one", "two", "**end**"])] + [("gone", 0, "x")], "k string, i int, t string")
    new = spark.createDataFrame([("d", i, t) for i, t in enumerate(["h", "uno", "end", "more"])], "k string, i int, t string")
    got = rows(diff.block_diff(old, new, "k", "t", "i").select("key", "kind", "old_text", "new_text", "before", "after"))
    assert got == [("d", "delete", "two", None, "one", "**end**"), ("d", "insert", None, "more", "end", ""), ("d", "replace", "one", "uno", "h", "end"), ("gone", "delete", "x", None, "", "")]


def test_tree_round_trip(spark):
    old = spark.createDataFrame([("t", '{"a": {"b": 1, "c~/": [1, 2]}, "e": {}}')], "k string, j string")
    new = spark.createDataFrame([("t", '{"a": {"b": 2, "c~/": [1]}, "e": {}, "f": null}')], "k string, j string")
    changes = diff.tree_diff(old, new, "k", "j")
    assert rows(changes) == [("t", "add", "/f", "null"), ("t", "remove", "/a/c~0~1/1", None), ("t", "replace", "/a/b", "2")]
    assert rows(diff.tree_apply(old, changes, "k", "j")) == rows(diff.tree_paths(new, "k", "j"))


def test_upserts_with_repeats_and_blanks(spark):
    target = spark.createDataFrame([("a ", "1", 1), ("a", "2", 2), ("b", "1", 3), ("z", "1", 4)], "k string, v string, pos int")
    seed = spark.createDataFrame([("a", "", 1), ("b", "2", 2), ("b", "3", 3), (" ", "9", 4), ("c", "1", 5)], "k string, v string, pos int")
    assert rows(diff.upsert_plan(target, seed, ["k"], ["v"])) == [("a", "skip", "", True), ("b", "update", "v", False), ("c", "create", "", False), ("z", "extra", "", False)]


def test_gates_in_order(spark):
    cols = "delta_hash string, resolution_status string, record_id string, table string, field string, new_value string, pos int"
    data = [("h1", "ambiguous", "r", "t", "f", "v", 1), ("h1", "resolved", "r", "t", "f", "v", 2), ("h2", "resolved", "r", "t", "f", "v", 3), ("h3", "resolved", "r", "t", "f", "v", 4), ("h4", "resolved", "r", "", "f", "v", 5), ("h5", "resolved", "r", "t", "f", "", 6), ("", "resolved", "r", "t", "f", "v", 7), (None, "resolved", "r", "t", "f", "v", 8)]
    approved = spark.createDataFrame([("h1",), ("h3",), ("h4",), ("h5",), ("",)], "delta_hash string")
    got = rows(diff.gate_stack(spark.createDataFrame(data, cols), approved).select("pos", "reason"), "pos")
    assert got == [(1, "not_resolved"), (2, "duplicate"), (3, "not_approved"), (4, None), (5, "no_field"), (6, "no_value"), (7, "not_approved"), (8, "not_approved")]


def test_written_value(spark):
    cell = lambda *v: F.array(*map(F.lit, v))
    row = spark.range(1).select(
        diff.written_value(F.lit("old "), F.lit("new"), F.lit("old"), cell(), cell()), diff.written_value(F.lit("| a | b |"), F.lit("| a | c |"), F.lit("b"), cell("a", "b"), cell("a", "c")),
        diff.written_value(F.lit("| a | a |"), F.lit("| b | c |"), F.lit("a"), cell("a", "a"), cell("b", "c")), diff.written_value(F.lit("x"), F.lit("y"), F.lit(""), cell(), cell()), diff.written_value(F.lit("| a |"), F.lit("| b | c |"), F.lit("a"), cell("a"), cell("b", "c")),
    ).first()
    assert tuple(row) == ("new", "c", None, None, None)


def test_verdicts(spark):
    long = "the battery must be charged before use"
    data = [(1, "m", "new text", None), (2, long, "", f"x {long} y"), (3, long, "", "other words entirely, nothing alike"), (4, "old", "new", "a new word"), (5, "old", "new", "an old word"), (6, long, "the battery has to be charged before using", "now the battery has to be charged before usage, always"), (7, long, "completely different replacement", "unrelated haystack of other things")]
    df = spark.createDataFrame(data, "i int, machine_text string, reviewer_text string, haystack string")
    assert rows(quality.verdicts(df).select("i", "verdict"), "i") == [(1, "source_missing"), (2, "rejected"), (3, "accepted_as_proposed"), (4, "accepted_as_proposed"), (5, "rejected"), (6, "accepted_as_proposed"), (7, "edited_further")]


def test_reconcile_by_route(spark):
    cols = "delta_hash string, route_class string, final_status string, source_path string, machine_text string, reviewer_text string"
    ledger = spark.createDataFrame([("a", "source_table_suggestion", "pending", "", "m", "r"), ("b", "source_table_suggestion", "", "", "m", "r"), ("c", "repo_review_text", None, "p", "m", "r"), ("d", "repo_review_text", "pending", "gone", "m", "r"), ("e", "repo_review_text", "rejected", "p", "m", "r"), ("f", "image", "pending", "p", "m", "r"), ("g", None, "pending", None, None, None)], cols)
    outcomes = spark.createDataFrame([("a", "written")], "delta_hash string, status string")
    sources = spark.createDataFrame([("p", "text with r in it")], "source_path string, haystack string")
    got = dict(rows(quality.reconciled(ledger, outcomes, sources).select("delta_hash", "final_status")))
    assert got == {"a": "accepted_as_proposed", "b": "pending", "c": "accepted_as_proposed", "d": "pending", "e": "rejected", "f": "pending", "g": "pending"}


def test_rules_on_bundles(spark):
    files = spark.createDataFrame([("a.rst", "{{left}} .. include:: b.rst\n.. image:: gone.png {{ snippet:warn }}"), ("b.rst", ".. image:: there.png")], "path string, text string")
    assets = spark.createDataFrame([("there.png",)], "path string")
    assert rows(quality.bundle_issues(files, assets).select("rule", "ref", "evidence")) == [("missing_file", "a.rst", '{"name":"gone.png"}'), ("unfilled_placeholder", "a.rst", '{"name":"left"}')]
    assert rows(quality.snippet_uses(files, "path", "text")) == [("b.rst", "a.rst"), ("warn", "a.rst")]
    bad = spark.createDataFrame([(1, "日本語", "en"), (2, "english", "ja"), (3, "123", "ja"), (4, "привет", "uk")], "i int, t string, lang string")
    assert rows(quality.script_mismatch(bad, "i", "t", "lang", {"en": "latin", "ja": "kana", "uk": "cyrillic"}).select("ref")) == [("1",), ("2",)]
    drift = spark.createDataFrame([(1, ["a", "b"], ["b", "c"])], "i int, l array<string>, r array<string>")
    assert quality.repeated_renderings(drift, "i", F.col("l"), F.col("r")).count() == 2
    sections = spark.createDataFrame([("p", "1", "A"), ("p", "1", "B"), ("p", "2", "C")], "page string, o string, name string")
    assert quality.order_collisions(sections, ["page"], "o", "name").count() == 1
    refs = spark.createDataFrame([(1, "f1, f2"), (2, None)], "i int, refs string")
    assert rows(quality.hashed(quality.unresolved_refs(refs, "i", "refs", spark.createDataFrame([("f1",)], "id string"), "id")).select("evidence")) == [('{"wanted":"f2"}',)]
    fixed = quality.repaired(sections, spark.createDataFrame([("p", "A", "Z")], "page string, name string, replacement string"), ["page", "name"], "name")
    assert {r.name for r in fixed.collect()} == {"Z", "B", "C"}


def test_search_ties_and_misses(spark):
    entries = spark.createDataFrame([("k", "Power on", {"en": "Power on", "fr": "Allumer"}, "t", 1), ("k", "Power on", {"en": "Power on", "fr": ""}, "t", 2), ("x", "Other", {"en": "Other"}, "u", 3)], "row_key string, source_text string, translations map<string,string>, table string, pos int")
    hit = search.search_memory(entries, "power power", source_lang="en", limit=5)
    assert rows(hit.select("pos", "score"), "pos") == [(1, 24 + 16 + 24 + 10), (2, 24 + 16 + 24 + 10)]
    assert rows(search.search_memory(entries, None, tables=["t"], target_lang="fr").select("pos", "score")) == [(1, 12)]
    assert search.search_memory(entries, "nowhere").count() == 0 and search.search_memory(entries, "", limit=0).count() == 1
    manuals = spark.createDataFrame([("B-1", ["Box One"], "Box guide"), ("B-2", ["Lamp"], "Lamp guide")], "id string, models array<string>, title string")
    assert [r.id for r in search.search_index(manuals, "box", ["id", "models"], ["title"]).collect()] == ["B-1"]
    assert search.search_index(manuals, "overview", ["id"], ["title"]).count() == 0


def test_inventory_and_manual_entries(spark):
    df = spark.createDataFrame([(s, t) for s, t in (("d4", ["x"]), ("d1", ["x", "x"]), ("d3", ["x"]), ("d2", ["x", "y"]))], "s string, t array<string>")
    found = metrics.inventory(df, "s", F.col("t"))
    assert rows(found) == [("x", 5, 4, "d1; d2; d3; +1 more"), ("y", 1, 1, "d2")]
    manual = spark.createDataFrame([("y", "hand"), ("z", "hand")], "target string, source string")
    assert rows(metrics.with_manual(found, manual)) == [("x", 5, "d1; d2; d3; +1 more"), ("y", 1, "d2; hand"), ("z", 0, "hand")]


def test_queue_claims_and_delivery(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    live = spark.createDataFrame([("a", ""), ("b", "RUNNING | claim_token=x | claim_expires_at=2024-01-01T01:00:00Z"), ("c", "RUNNING | claim_token=x | claim_expires_at=2023-01-01T01:00:00Z")], "record_id string, result string")
    asked = spark.createDataFrame([("a", "t2"), ("a", "t1"), ("b", "t1"), ("c", "t9"), ("zz", "t1")], "record_id string, token string")
    got = queue.claimed(live, asked, now)
    assert rows(got.select("record_id", "token", "granted")) == [("a", "t1", True), ("a", "t2", False), ("b", "t1", False), ("c", "t9", True), ("zz", "t1", False)]
    assert got.where("token = 't9'").first().result == "RUNNING | claim_token=t9 | claim_expires_at=2024-01-01T02:00:00Z"
    d = spark.createDataFrame([("publish", "u", "Success", True), ("draft", "u", "Success", False), ("publish", "", "Success", True), ("other", "u", "Success", True)], "a string, u string, r string, b boolean")
    assert [tuple(r.d) for r in d.select(queue.delivery("a", "u", "r", F.col("b")).alias("d")).collect()] == [("pdf", "u", True, False), ("cloud_doc", "u", True, True), ("pdf", "", False, False), ("none", "u", False, False)]
    first = queue.with_first_in_group(spark.createDataFrame([("g", 2), ("g", 1)], "g string, pos int"), ["g"])
    assert rows(first.select("pos", "leads")) == [(1, True), (2, False)]


def test_exact_repeats_tell_nulls_apart(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "a", None), (4, None, None), (5, None, None)], "line int, x string, y string")
    assert sorted(r.line for r in metrics.without_repeats(df, ["x", "y"], "line").collect()) == [1, 2, 4]
    assert sorted((r.line, r.first_line) for r in metrics.exact_repeats(df, ["x", "y"], "line").collect()) == [(3, 1), (5, 4)]


def test_status_prefix_is_the_whole_label(spark):
    df = spark.createDataFrame([(1, "Online: yes\nON: no\non : x\nBlinking\u00a0: y\nno colon")], "k int, t string")
    assert [json.loads(r.evidence)["prefix"] for r in quality.status_prefixes(df, "k", "t", ["ON", "Blinking"]).collect()] == ["Online"]


def test_broken_json_is_a_leaf(spark):
    df = lambda t: spark.createDataFrame([(1, t), (2, '{"a": 1}')], "k int, t string")
    got = diff.tree_diff(df("{broken"), df("[1]"), "k", "t").collect()
    assert sorted((r.key, r.op, r.path, r.value) for r in got) == [("1", "add", "/0", "1"), ("1", "remove", "", None)]


def test_asset_overrides_are_settled_in_the_request_row(spark):
    """No row a request times assets that have to be sorted; requests without a key, a model or an asset too."""
    assets = spark.createDataFrame([("logo", " all", "base"), ("logo", "A,B", "ab"), ("logo", "b", "b"), ("icon", None, "i1"), ("icon", "", "i2"), ("own", "A", None)], "asset_key string, scope string, asset string")
    asked = spark.createDataFrame([(1, "logo", "a"), (2, "logo", "B"), (3, "logo", "C"), (4, "logo", None), (5, "icon", "A"), (6, "none", "A"), (7, None, "A"), (8, "own", "A"), (9, "own", "B"), (None, "logo", "A")], "request_id int, asset_key string, model string")
    found = lookup.base_and_override(assets, asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    got = {r.request_id: (r.asset, r.scope, r.status) for r in found.collect()}
    assert got == {
        1: ("ab", "A,B", "found"), 2: (None, None, "ambiguous"), 3: ("base", " all", "found"), 4: ("base", " all", "found"), 5: (None, None, "ambiguous"), 6: (None, None, "missing"),
        7: (None, None, "missing"), 8: (None, "A", "found"), 9: (None, None, "missing"), None: ("ab", "A,B", "found"),
    }
