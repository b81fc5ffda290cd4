from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import checks

COLUMNS = ("line", "document_key", "Model", "Region", "Source_lang", "Is_Latest", "Row_key", "Row_label_source", "Value_source")


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'line' else 'string'}" for c in COLUMNS))


ROWS = [
    (1, "M1_US", "M1", "US", "en", "TRUE", "power", "Power", "1 W"), (2, "M1_US_en", "M1", "US", "en", "TRUE", "mass", "Mass", ""), (3, "", "M1", "US", "", "TRUE", "size", None, "3"),
    (4, "M9_US", "M1", "US", "xx", "TRUE", "size", "Size", "3"), (5, "M1_US", "", "", "en", "TRUE", "k", "K", "V"), (6, "M1_US", "M1", "US", "en", "FALSE", "old", "", ""),
    (7, "M2_EU", "M2_EU", "EU", "de", "TRUE", "a", "A", "B"), (8, "", "M2", "EU", None, "TRUE", " ", None, None), (9, "", "", "", "en", "TRUE", "lost", "L", "V"),
]


def test_rules_of_a_target_in_one_scan(spark, tmp_path):
    frame(spark, ROWS).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    found, observed = checks.checked(rows.where("Is_Latest = 'TRUE'"), checks.specification_rules(), ["Model", "Region"], "line")
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = sorted((int(r.ref), r.code) for r in found.collect())
    assert got == [(2, "missing_source_value"), (3, "missing_document_key"), (3, "missing_source_lang"), (3, "missing_source_row_label"), (4, "invalid_document_key"), (4, "invalid_source_lang"), (9, "missing_document_key")]
    assert observed.get == {"rows": 8, "missing_source_lang": 1, "invalid_source_lang": 1, "missing_document_key": 2, "invalid_document_key": 1, "missing_source_row_label": 1, "missing_source_value": 1}
    told = {r.ref: r.message for r in found.where("code = 'invalid_document_key'").collect()}
    assert told == {"4": "row size has a document key other than M1_US or M1_US_xx"}


def test_targets_meet_their_rows_by_place_or_key_once(spark):
    targets = spark.createDataFrame([("t1", "M1", "US"), ("t2", "M2", "EU"), ("t3", None, "EU"), ("t4", "m1", "us")], "target string, model string, region string")
    got = sorted((r.target, r.line) for r in checks.rows_of_targets(frame(spark, ROWS), targets).collect())
    assert got == [*[("t1", i) for i in (1, 2, 3, 4, 5)], ("t2", 7), ("t2", 8), *[("t4", i) for i in (1, 2, 3, 4)]]


def test_report_by_target(spark):
    rules = {"high": checks.Rule(F.col("v") > 2, "FAIL", "too high"), "odd": checks.Rule(F.col("v") % 2 == 1, "WARN")}
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("b", 3, 1), ("c", 4, 2), ("b", 5, None)], "t string, i int, v int")
    found, observed = checks.checked(rows, rules, ["t"], "i")
    out = sorted(map(tuple, checks.report(found, ["t"]).select("t", "code", "severity", "n", "first_ref", "status").collect()))
    assert out == [("a", "high", "FAIL", 1, "2", "FAIL"), ("a", "odd", "WARN", 2, "1", "FAIL"), ("b", "odd", "WARN", 1, "3", "WARN")]
    none, empty = checks.checked(rows.where("false"), rules, ["t"], "i", "none")
    assert none.collect() == [] and empty.get == {"rows": 0, "high": 0, "odd": 0}
