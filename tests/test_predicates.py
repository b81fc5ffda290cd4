from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import predicates as p

MATRIX = [  # kind, blank cell, ALL, a match, another, no target and a named cell
    ("spec", True, False, True, False, True), ("memory", True, True, True, False, True), ("symbol_market", False, True, True, False, False), ("block_model", True, True, True, False, False),
    ("trouble_region", True, True, True, False, True), ("asset", False, True, True, False, False), ("sku", True, True, True, False, True),
]


@pytest.mark.parametrize(("kind", "blank", "everyone", "match", "other", "untargeted"), MATRIX)
def test_dimensions(spark, kind, blank, everyone, match, other, untargeted):
    sep = "|" if kind == "sku" else ","
    ask = lambda cell, target: p.applies(F.lit(cell), F.lit(target), kind)
    row = spark.range(1).select(ask("", "M1"), ask(" ALL ", "M1"), ask(f"M0 {sep}M1", "M1"), ask("M2", "M1"), ask("M2", " ")).first()
    assert tuple(row) == (blank, everyone, match, other, untargeted)


def test_targets_and_cases(spark):
    row = spark.range(1).select(
        p.applies(F.lit("Box_EU"), F.lit("box"), "spec", F.lit("EU")), p.applies(F.lit("Box_EU"), F.lit("box"), "spec"), p.applies(F.lit("m1"), F.lit("M1"), "sku"), p.applies(F.lit("m1"), F.lit("M1"), "spec"),
        p.applies(F.lit(None), F.lit("x"), "spec"), p.applies(F.lit("ALL"), F.lit(None), "block_model"), p.applies(F.lit(""), F.lit(None), "asset"),
    ).first()
    assert tuple(row) == (True, False, False, True, True, True, False)


def test_pages_and_slots(spark):
    pages = F.array(F.lit("Specs"))
    row = spark.range(1).select(p.page_applies(F.lit("a；specs"), pages), p.page_applies(F.lit(""), pages), p.page_applies(F.lit("a"), pages), p.page_applies(F.lit("a"), F.array().cast("array<string>"))).first()
    assert tuple(row) == (True, True, False, True)
    slots = spark.createDataFrame([("role",), ("place.role",), ("place.v.role",), ("a.b.c.d",), ("a..b",), (None,)], "s string")
    got = [r.x and tuple(r.x) for r in slots.select(p.slot_parts("s").alias("x")).collect()]
    assert got == [("", "", "role"), ("place", "", "role"), ("place", "v", "role"), None, None, None]
    assert spark.range(1).select(p.slot_key(F.lit("a"), F.lit(""), F.lit("r"))).first()[0] == "a.r"


def test_filters(spark):
    df = spark.createDataFrame([(1, "Open", "task-1", "EU", None), (2, "open", "task-2", None, "US"), (3, "closed", "job", "EU", "EU")], "i int, state string, task string, a string, b string")
    ids = lambda **k: [r.i for r in df.where(p.matches_all(**k)).orderBy("i").collect()]
    assert ids(equal={"state": "OPEN"}) == [1, 2] and ids(begins={"task": "TASK"}) == [1, 2] and ids(holds={"task": "2", "state": ""}) == [2]
    assert ids(among=(["a", "b"], ["us"])) == [2] and ids() == [1, 2, 3]


def test_all_if_none(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", False), ("b", False)], "g string, m boolean")
    assert sorted((r.g, r.m) for r in df.where("true").withColumn("k", p.all_if_none(F.col("m"), "g")).where("k").collect()) == [("a", True), ("b", False), ("b", False)]
