from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import records


def test_a_key_that_stands_twice_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert records.strict_keys(df, ["k"]).count() == 2
    with pytest.raises((PySparkException, Py4JJavaError), match="several rows of key 1"):
        records.strict_keys(df.unionByName(df), ["k"]).collect()


def test_roots_are_taken_in_order():
    assert records.snapshot_root([("explicit", False), ("active", True), ("legacy", True)]) == "active"
    assert records.snapshot_root([("", True), ("x", False)]) is None


def test_config_targets(spark, tmp_path):
    for name, text in (("a.yaml", "model: 'M1'\nregion: EU # here\nother: x\n"), ("b.yaml", "region: EU\nmodel: M1\n"), ("c.yaml", "model: M2\n"), ("d.yaml", 'model: "M3"\nregion: US\n  model: inner\n')):
        (tmp_path / name).write_text(text)
    got = records.config_targets(spark, f"{tmp_path}/*.yaml").collect()
    assert sorted((r.model, r.region) for r in got) == [("M1", "EU"), ("M3", "US")]


def test_section_audit(spark):
    rows = [
        (1, "d", "General", "1", "fine", "a.b", "en"), (2, "d", "Safety", "1", "other", None, "en"), (3, "d", "General", "1", "fine", "", "en"),
        (4, "d", "More", "2", "only latin", "a b", "zh"), (5, "d", "More", "2", "有 latin", None, "zh"), (6, "d", "More", "3", "TBD", None, "en"), (7, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "line int, doc string, section string, ord string, text string, slot string, lang string")
    got = sorted((r.rule, r.ref) for r in records.section_audit(df, ["doc"], "section", "ord", "text", "slot", "lang", "line").collect())
    assert got == [("bad_slot_key", "4"), ("exact_repeat", "3"), ("order_collision", "d"), ("order_collision", "d"), ("script_mismatch", "4"), ("suspect_value", "6")] or got == [("bad_slot_key", "4"), ("exact_repeat", "3"), ("order_collision", "d"), ("script_mismatch", "4"), ("suspect_value", "6")]


def test_empty_tables(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    kv = empty("key string, value string")
    assert records.staged(kv, kv, kv, kv).count() == 0
    assert records.asset_crosscheck(kv, kv, kv, "key").count() == 0
    assert records.footnote_issues(empty("scope string, footnote_id string, ord string, lang string, text string"), empty("scope string, footnote_id string")).count() == 0
    assert records.signal_words(empty("request_id int, word string, lang string"), empty("word string, lang string, label string")).count() == 0
    assert records.distinct_and_sum(kv.withColumn("n", F.lit(1)), "key", "n").first().asDict() == {"keys": 0, "total": 0}
