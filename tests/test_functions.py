from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import text, udfs, values, variants


def one(spark, **cols):
    """The values of literal expressions, in one row."""
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first().asDict(recursive=True)


FLAG_CASES = [  # kind, blank, yes, off, unknown word
    ("spec", True, True, False, False), ("copy", False, True, False, False), ("copy_default_true", True, True, False, True), ("lint", False, True, False, False), ("memory_latest", True, True, False, False),
    ("memory_enabled", True, True, False, True), ("index_latest", True, True, False, True), ("variable_default", False, True, False, False), ("block", True, True, False, True), ("localized", True, True, False, False),
]


@pytest.mark.parametrize(("kind", "blank", "yes", "no", "other"), FLAG_CASES)
def test_flags_read_differently(spark, kind, blank, yes, no, other):
    got = one(spark, null=values.flag(F.lit(None).cast("string"), kind), blank=values.flag(F.lit("  "), kind), yes=values.flag(F.lit(" Yes "), kind), no=values.flag(F.lit("FALSE"), kind), other=values.flag(F.lit("perhaps"), kind))
    assert got == {"null": blank, "blank": blank, "yes": yes, "no": no, "other": other}


def test_builder_flags_know_two_words_and_do_not_trim(spark):
    got = one(spark, a=values.flag(F.lit(""), "builder"), b=values.flag(F.lit(" "), "builder"), c=values.flag(F.lit("yes"), "builder"), d=values.flag(F.lit("1"), "builder"), e=values.flag(F.lit("off"), "index_latest"))
    assert got == {"a": True, "b": False, "c": False, "d": True, "e": False}


def test_boolish(spark):
    got = one(spark, a=values.boolish(F.lit("y"), "upper_bool"), b=values.boolish(F.lit("No"), "digit_bool"), c=values.boolish(F.lit("maybe "), "upper_bool"), d=values.boolish(F.lit(None), "digit_bool"))
    assert got == {"a": "TRUE", "b": "0", "c": "maybe", "d": ""}


def test_times(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T05:04:05+02:00", "2024-01-02 03:04:05", "1704164645", "1704164645000", "0", "-5", "soon", "", None, "2024-13-01"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", values.iso_seconds(values.time_of("t")).alias("x")).orderBy("i").collect()]
    assert got == ["2024-01-02T03:04:05+00:00"] * 5 + [""] * 6


def test_result_fields_and_claims(spark):
    got = one(spark, r=values.result_fields(F.lit(" Success | Version = 2 | x | version=3 | built_at=2024-01-01T00:00:00Z")), none=values.result_fields(F.lit(None).cast("string")))
    assert got["r"] == {"status": "success", "values": {"version": "3", "built_at": "2024-01-01T00:00:00Z"}} and got["none"] == {"status": "", "values": {}}
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    claims = ["RUNNING | claim_token=a | claim_expires_at=2024-01-01T12:00:01Z", "RUNNING | claim_token=a | claim_expires_at=2024-01-01T12:00:00Z", "RUNNING | claim_expires_at=2099-01-01T00:00:00Z", "RUNNING | claim_token=a | claim_expires_at=never", "SUCCESS | claim_token=a | claim_expires_at=2099-01-01T00:00:00Z", None]
    df = spark.createDataFrame(list(enumerate(claims)), "i int, c string")
    assert [r.a for r in df.select("i", values.claim_active("c", now).alias("a")).orderBy("i").collect()] == [True, False, False, False, False, False]


FRESH = [
    ("x", None, None, "not_requested", None), ("Success | built_at=2024-01-02T00:00:00Z", None, "2024-01-02T00:00:00Z", "fresh_success", True), ("Failure | built_at=2024-01-03", None, "2024-01-02T00:00:00Z", "fresh_failure", True), ("Done | built_at=2024-01-03", None, "2024-01-02T00:00:00Z", "fresh_result", True),
    ("Success | built_at=2024-01-01", None, "2024-01-02T00:00:00Z", "stale_result", False), ("Success", "2024-01-02", "2024-01-02T00:00:00Z", "writeback_pending", None), ("", "2024-01-01", "2024-01-02T00:00:00Z", "pending", None), ("Success", None, "2024-01-02T00:00:00Z", "stale_result", False),
]


def test_freshness(spark):
    df = spark.createDataFrame([(i, *f[:3]) for i, f in enumerate(FRESH)], "i int, r string, s string, a string")
    got = df.select("i", values.freshness("r", "s", "a").alias("f")).orderBy("i").collect()
    assert [(r.f["status"], r.f["is_fresh"]) for r in got] == [f[3:] for f in FRESH]


def test_versions_sort_by_number(spark):
    df = spark.createDataFrame([(v,) for v in ("1.9", "1.10", "v2", "draft", "", "V1.9.1")], "v string")
    assert [r.v for r in df.orderBy(values.version_key("v")).collect()] == ["", "draft", "1.9", "V1.9.1", "1.10", "v2"]


CONVERSIONS = [
    (("exclude", "x", "", "US"), (None, "excluded")), (("default", "x", "d", "US"), ("d", "direct")), (("capacity", "", "d", ""), ("d", "direct")), (("capacity", "", "", ""), (None, "needs_review")), (("passthrough", " a  b ", "", ""), ("a b", "direct")),
    (("capacity", "1024 Wh 51.2 V 20 Ah", "", ""), ("1024 Wh (20 Ah / 51.2 V DC)", "transformed")), (("capacity", "1024 Wh", "", ""), ("1024 Wh", "needs_review")), (("weight", "10.5 kg", "", "us"), ("About 23.15 lbs/10.5 kg", "transformed")), (("weight", "10.5 KG", "", "EU"), ("About 10.5 kg", "transformed")),
    (("dims_mm_to_cm", "254 mm x 100mm x 55 mm", "", "US"), ("10.0 × 3.9 × 2.2 in / 25.4 × 10 × 5.5 cm", "transformed")), (("dims_mm_to_cm", "254 mm", "", ""), ("254 mm", "needs_review")), (("temp", "-10~45 ℃", "", "US"), ("14 °F to 113 °F / -10 °C to 45 °C", "needs_review")), (("temp", "-10~45 ℃", "", "EU"), ("-10 °C to 45 °C", "needs_review")),
    (("cycle_life", "4000 cycles", "", ""), ("4000 cycles to 70%+ capacity", "transformed")), (("dc12", "12 V, max 10 A", "", ""), ("12 V⎓10 A max.", "transformed")), (("manual", "x", "", ""), ("x", "needs_review")),
]


def test_conversions(spark):
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(CONVERSIONS)], "i int, op string, raw string, d string, r string")
    got = df.select("i", values.converted("op", "raw", "d", "r").alias("c")).orderBy("i").collect()
    assert [(r.c["value"], r.c["status"]) for r in got] == [c[1] for c in CONVERSIONS]


def test_rates(spark):
    got = one(spark, a=values.rate(F.lit(1), F.lit(3)), b=values.rate(F.lit(1), F.lit(0)), c=values.rate(F.lit(None), F.lit(3)), d=values.percent_text(F.lit(898), F.lit(976)))
    assert got == {"a": 0.3333, "b": None, "c": None, "d": "92.0%"}


def test_texts(spark):
    s = F.lit
    got = one(
        spark, collapsed=text.collapsed(s(" a \t b\n")), first=text.first_filled(s(" "), s(None), s(" x ")), none=text.first_filled(s(None), s("")), alias=text.alias_filled(s(" "), s("b")), norm=text.inline_norm(s("**A**​ <b>“q”</b> ![i](x.png)")),
        model=text.model_token(s("Box-1_eu"), s("EU")), dash=text.model_token(s("Box-eu"), s("EU")), plain=text.model_token(s("Box"), s("EU")), open=text.model_token(s("Box_EU"), s("")), tokens=text.tokens(s("a, b;;a\nc ")), full=text.tokens(s("a、b，c|d"), text.SEPARATORS["copy_tags"]),
        literal=text.literal_list(s("['A', \"B\", 'A']")), cell=text.literal_list(s("A|B")), short=text.short_name(s("Acme  Box"), "acme"), label=text.lowered_label(s("Press BUTTON for AC Output")), pv=text.param_value(s("P"), s("v"), s("zh")), only=text.param_value(s(""), s("v"), s("en")),
        wide=text.display_width(s("ab漢字カ")), east=text.is_east_asian(s("x한")), latin=text.is_east_asian(s("é")), search=text.search_tokens(s("Ab c.d カナ漢字")), sentences=text.sentences(s("One. Two! One.\nThree")), cells=text.cells(s("| a | <b>b</b><br/>c</td>|")), padded=text.zero_padded(s("7.0"), 3),
        key=text.composite_key(s("A b"), s(""), s("C/d")), split=text.split_key(s("A_B_EU")), link=text.unlinked(s("[t](http://x)")), c1=text.circled(s(3)), c2=text.circled(s(21)), filled=text.substituted(s("{{a}} {{b}} {{c}}"), F.create_map(s("a"), s("1"), s("b"), s(None).cast("string"))),
        log=text.log_line(s("/home/u/x/file.rst:12:3: bad  thing")), urls=text.urls(s("see https://a.b/c?d=1). And http://x.y,")), mails=text.emails(s("A.b@C.de, no@x")), items=text.list_items(s("- one\n2. two\n<ul><li>th<b>r</b>ee</li></ul>")), ko1=text.with_particle(s("제품"), "은", "는"), ko2=text.with_particle(s("배터리"), "은", "는"),
        html=text.escaped(s('<a & "b">'), "html"), latex=text.escaped(s("a\\b{c}_%"), "latex"), masked=text.masked(s("Box Pro Max and Box"), ["Box", "Box Pro Max"]), outside=text.outside(s("bat battery bat"), s("bat\\w*"), s("battery")), degree=text.unit_value(s("5"), s("°C")), watt=text.unit_value(s("5"), s("W")),
        ratio=text.script_ratio(s("Привет ab"), "cyrillic"), noletters=text.script_ratio(s("123"), "han"), forms=text.derived_forms(s("k"), s("Big AC")),
    )
    want = {
        "collapsed": "a b", "first": "x", "none": "", "alias": "b", "norm": 'A "q" [image]', "model": "Box-1", "dash": "Box", "plain": "Box", "open": "Box_EU", "tokens": ["a", "b", "c"], "full": ["a", "b", "c", "d"], "literal": ["A", "B"], "cell": ["A", "B"], "short": "Box",
        "label": "press button for AC output", "pv": "P：v", "only": "v", "wide": 8, "east": True, "latin": False, "search": ["ab", "c.d", "カナ", "漢字"], "sentences": ["One.", "Two!", "Three"], "cells": ["a", "b", "c"], "padded": "007", "key": "a_b__c_d", "split": {"model": "A_B", "region": "EU"},
        "link": {"text": "t", "address": "http://x"}, "c1": "③", "c2": "(21)", "filled": "1  {{c}}", "log": "file.rst:N: bad thing", "urls": ["https://a.b/c?d=1", "http://x.y"], "mails": ["a.b@c.de"], "items": ["one", "two", "th r ee"], "ko1": "제품은", "ko2": "배터리는",
        "html": "&lt;a &amp; &quot;b&quot;&gt;", "latex": "a\\textbackslash{}b\\{c\\}\\_\\%", "masked": "  and  ", "outside": ["bat", "bat"], "degree": "5°C", "watt": "5 W", "ratio": 0.75, "noletters": None, "forms": {"k": "Big AC", "k_BOLD": "**Big AC**", "k_LOWER": "big AC"},
    }
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_sort_tokens(spark):
    df = spark.createDataFrame([(v,) for v in ("10", "9", "b", "A", "", None, "1.5")], "v string")
    assert [r.v for r in df.orderBy(text.sort_token("v"), F.col("v").asc_nulls_last()).collect()] == ["1.5", "9", "10", "", None, "A", "b"]


def test_cells_of_json(spark):
    raw = ["null", "true", "3", "3.0", "0.1234567", '["a", 1, null]', '{"b": 1, "a": "é"}', '"x"', None, "not json"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, j string")
    got = [r.t for r in df.select("i", variants.cell_text("j").alias("t")).orderBy("i").collect()]
    assert got == ["", "TRUE", "3", "3", "0.123457", "a, 1, ", '{"a":"é","b":1}', "x", "", "not json"]
    pick = spark.createDataFrame([('[{"text": " "}, {"name": "n"}, "s"]',), ('{"text": "t", "value": "v"}',)], "j string")
    assert [r.t for r in pick.select(variants.choice_text("j").alias("t")).collect()] == ["n, s", "t"]


def test_hashes_do_not_depend_on_key_order(spark):
    df = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"b":null,"a":1}',), ('{"a": 1}',)], "j string")
    h = [r.h for r in df.select(udfs.content_hash("j").alias("h")).collect()]
    assert h[0] == h[1] != h[2]


def test_search_form_and_partial_ratio(spark):
    got = one(spark, a=udfs.search_form(F.lit("ＡＢ－ｃ  Straße!")), r=udfs.partial_ratio(F.lit("abcd"), F.lit("xxabcdxx")), none=udfs.partial_ratio(F.lit(""), F.lit("x")))
    assert got == {"a": "ab c strasse", "r": 1.0, "none": 0.0}
    assert udfs.partial_ratio_of("kitten sitting", "the kitten sittin there") > 0.9


def test_stretch_distance_by_definition():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for n in (9, 20))
        row = [0] * (len(b) + 1)  # the table of edits, a stretch may begin anywhere
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert udfs.stretch_distance(a, b) == min(row)
    assert udfs.partial_ratio_of("abcd", "xxabcdxx") == 1.0 and udfs.partial_ratio_of("xabed", "abcd") == 0.75


def test_korean_endings(spark):
    got = one(spark, **{f"c{i}": text.ends_closed(F.lit(t), {"acme": False}) for i, t in enumerate(["제품", "배터리", "Box 3", "Box 2.", "The Acme", "Box", " ", "(제품)"])})
    assert list(got.values()) == [True, False, True, False, False, None, None, True]


def test_cells_of_any_json(spark):
    rows = {"[1, [], [\"a\", null, true]]": "1, , a, , TRUE", '{"b": 1.0, "a": {"x": []}}': '{"a":{"x":[]},"b":1}', "1e6": "1000000", "1234567.5": "1.23457e+06", "-0.00001234567": "-1.23457e-05", "0.0001": "0.0001", "123456.7": "123457", "100.25": "100.25", "-7": "-7", "1.5e300": None, '"\\u00e9"': "é", "[" * 3000 + "]" * 3000: "[" * 3000 + "]" * 3000, '{"a": 1, "a": 2}': '{"a": 1, "a": 2}', "[[[[[[1]]]]]]": "[[1]]"}
    df = spark.createDataFrame([(k,) for k in rows], "j string")
    got = {r.j: r.t for r in df.select("j", variants.cell_text("j").alias("t")).collect()}
    assert {k: got[k] for k, want in rows.items() if want is not None} == {k: want for k, want in rows.items() if want is not None} and got["1.5e300"].startswith("15")
    picks = {'[{"text": " "}, {"name": ["p", "q"]}, [], 3]': "p, q, 3", "null": "", '{"value": 2.50}': "2.5", "plain words": "plain words", '{"text": {"k": 1}}': '{"k":1}'}
    df = spark.createDataFrame([(k,) for k in picks], "j string")
    assert {r.j: r.t for r in df.select("j", variants.choice_text("j").alias("t")).collect()} == picks
    assert spark.createDataFrame([("[" * 100_000,), ("[" * 100_000 + "]" * 100_000,)], "j string").where(udfs.canonical_json("j").isNull()).count() == 2
