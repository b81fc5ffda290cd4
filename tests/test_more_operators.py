from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import diff, lookup, pages, quality, requests
from tessera.sources import schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_references(spark):
    df = spark.createDataFrame([(1, "r2, r1,r9"), (2, ""), (3, None)], "i int, refs string")
    known = spark.createDataFrame([("r1", "b1"), ("r2", "b2")], "record_id string, business_id string")
    assert rows(lookup.refs_to_ids(df, "i", "refs", known)) == [(1, "b2,b1", "r9"), (2, "", ""), (3, "", "")]


def test_memory_writes(spark):
    memory = spark.createDataFrame([("m1", "fr", "un"), ("m2", "fr", "deux "), ("m3", "fr", "dup"), ("m4", "fr", "dup"), ("m5", "de", "un")], "record_id string, lang string, text string")
    asked = spark.createDataFrame([("h1", "fr", " un", "une"), ("h2", "fr", "gone", "deux"), ("h3", "fr", "dup", "x"), ("h4", "es", "un", "uno")], "delta_hash string, lang string, old_text string, new_text string")
    assert rows(lookup.memory_writes(asked, memory)) == [("h1", "m1", "write"), ("h2", "m2", "already"), ("h3", None, "ambiguous"), ("h4", None, "missing")]


def test_seed_plan_and_scopes(spark):
    slots, sources = spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), spark.createDataFrame([("a", "s1"), ("b", "s1"), ("b", "s2")], "k string, r string")
    assert rows(lookup.seed_plan(slots, sources, "k", "r")) == [("a", "s1", "copy"), ("b", None, "needs_input"), ("c", None, "needs_input")]
    langs = F.array(F.lit("en"), F.lit("fr"), F.lit("de"))
    row = spark.range(1).select(lookup.narrowed(langs, F.array(F.lit("DE"), F.lit("en"))), lookup.narrowed(langs, F.lit(None).cast("array<string>")), lookup.narrowed(langs, F.array().cast("array<string>"))).first()
    assert list(row) == [["en", "de"], ["en", "fr", "de"], ["en", "fr", "de"]]
    pages = spark.createDataFrame([("d", "wifi"), ("d", "intro"), ("e", "wifi")], "document_key string, page string")
    caps = spark.createDataFrame([("d", "net", False)], "document_key string, capability string, has boolean")
    rules = spark.createDataFrame([("net", "wifi", True)], "capability string, page string, forbidden boolean")
    assert rows(lookup.allowed_pages(pages, caps, rules)) == [("d", "intro"), ("e", "wifi")]


def test_three_way_merge(spark):
    side = lambda **kv: spark.createDataFrame(list(kv.items()), "k string, v string")
    got = diff.merged_edits(side(a="1", b="1", c="1", d="1", e="1"), side(a="2", b="2", d="1", f="2", e="1"), side(a="1", b="9", c="9", g="9", e="1"), "k", "v")
    assert rows(got) == [("a", "2", "source"), ("b", "9", "review"), ("c", "9", "review"), ("e", "1", "source"), ("f", "2", "source"), ("g", "9", "review")]
    edits = spark.createDataFrame([("en", "EN"), ("fr", "en"), (None, "en")], "lang string, source_lang string")
    assert [r.target for r in diff.routed_edits(edits).collect()] == ["source_table", "translation_memory", "source_table"]
    now, frozen = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string"), spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "path string, sha256 string")
    assert rows(diff.verified(now, frozen)) == [("b", "changed"), ("c", "missing")] and diff.verified(now, now).count() == 0


def test_run_keys_and_parameters(spark):
    many = [f'{{"i": {i}}}' for i in range(60)]
    report = lambda n, model="m": f'{{"model": "{model}", "changes": [{", ".join(many[:n])}]}}'
    df = spark.createDataFrame([(report(50),), (report(60),), (report(49),), (report(50, "x"),)], "j string")
    a, b, c, d = (r.k for r in df.select(quality.run_key(F.col("j")).alias("k")).collect())
    assert a == b and len({a, c, d}) == 3
    row = spark.range(1).select(*[quality.parameter_only(F.lit(x), F.lit(y)) for x, y in (("t\n:a: 1", "t\n:a: 2"), ("t\n:a: 1", "u\n:a: 2"), (":a: 1", ":b: 1"), (":a: 1", ":a: 1"))]).first()
    assert tuple(row) == (True, False, False, False)


def test_targets(spark):
    got = spark.range(1).select(*[text.split_target(F.lit(t), ["EU", "US"]) for t in ("A_US_B_eu_fr", "A_B", "EU")]).first()
    assert [tuple(x) for x in got] == [("A_US_B", "eu", "fr"), ("A_B", "", ""), ("", "EU", "")]


def test_questions():
    known = {"model": ["Box", "Box Pro"], "region": ["EU", "US"]}
    assert requests.inferred("Is the latest box pro manual for us published? v1.2", known) == {"model": "Box Pro", "region": "US", "version": "1.2", "latest": "true", "action": "publish"}
    assert requests.inferred("boxes", known) == {}
    assert requests.merged({"region": "EU", "model": ""}, "status of Box in US", known) == {"model": "Box", "region": "EU", "action": "status"}


def test_schema_is_applied_once(spark):
    name, spec = f"t_{uuid.uuid4().hex}", schema.TableSpec("t", ("a", "b"))
    try:
        assert schema.apply_schema(spark, schema.TableSpec("t", ("a",)), name) == [("", "create_table")]
        assert schema.apply_schema(spark, schema.TableSpec("t", ("a",)), name, write=True) == [("", "create_table")]
        assert schema.apply_schema(spark, spec, name, write=True) == [("b", "add")]
        assert schema.apply_schema(spark, spec, name) == [] and spark.table(name).columns == ["a", "b"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_page_blocks_fail_on_another_page(spark):
    rows = spark.createDataFrame([(1, "lcd"), (2, "symbols")], "n int, page_id string")
    with pytest.raises(Exception, match="names another page"):
        pages.page_blocks(rows, "lcd").collect()
    assert [r["page_id"] for r in pages.page_blocks(rows.drop("page_id"), "lcd").collect()] == ["lcd", "lcd"]


def test_queue_rows_fail_without_an_id(spark):
    rows = spark.createDataFrame([(" ", {"Doc": '"x"'})], "record_id string, fields map<string,string>")
    with pytest.raises(Exception, match="no record_id"):
        pages.queue_rows(rows, {"document": ["Doc"]}).collect()


def test_names_that_two_owners_share(spark):
    rows = spark.createDataFrame([(1, "a", "Bolt X Bolt"), (2, "c", "Bolt"), (3, None, "Bolt"), (4, "a", None)], "id int, owner string, text string")
    names = spark.createDataFrame([("a", "Bolt"), ("b", "Bolt"), ("b", "X"), ("b", " ")], "owner string, name string")
    found = quality.foreign_identity(rows, "id", "text", "owner", names)
    assert sorted((r["ref"], r["evidence"]) for r in found.collect()) == [("1", '{"name":"X"}'), ("2", '{"name":"Bolt"}')]
    assert quality.foreign_identity(rows, "id", "text", "owner", names.where("false")).count() == 0


def test_terminology_rules_of_any_number(spark):
    rows = spark.createDataFrame([(1, "EN", "foo12 foo7"), (2, "fr", "foo7"), (3, None, "foo7"), (4, "en", None)], "id int, lang string, text string")
    rules = spark.range(3000).selectExpr("concat('r', id) AS rule_id", "'en' AS lang", r"concat('\\bfoo', id, '\\b') AS deprecated_regex", "'' AS allow_regex", "'bar' AS preferred")
    found = quality.terminology(rows, "id", "text", "lang", rules)
    assert sorted((r["ref"], r["evidence"]) for r in found.collect()) == [("1", '{"hit":"foo12","rule_id":"r12"}'), ("1", '{"hit":"foo7","rule_id":"r7"}')]
    assert quality.terminology(rows, "id", "text", "lang", rules.where("false")).count() == 0
