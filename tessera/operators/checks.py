"""All row rules of a table in one scan: findings by target, with the counts observed on the way.

A rule is a condition that a row must not meet. Rules run together as one projection over one read of the table; how many rows each
rule met is an observation of that same pass, known once the findings were written or counted, without a second job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.text import SOURCE_LANGUAGES, filled, model_token


@dataclass(frozen=True)
class Rule:
    """broken: what a row must not meet (null counts as met by none); severity: FAIL or WARN; message: a Column or text."""

    broken: Column
    severity: str = "FAIL"
    message: Column | str = ""


def checked(rows: DataFrame, rules: Mapping[str, Rule], target: Sequence[str], ref: str, name: str = "checks") -> tuple[DataFrame, Observation]:
    """(findings, observed): (target columns, ref, code, severity, message) for each rule that a row breaks, and an observation of
    `rows` and, by code, of the rows that break it. A code's name must not be `rows`. No rows: no findings, and counts of zero.
    """
    observed = Observation(name)
    broken = {code: F.coalesce(rule.broken, F.lit(False)) for code, rule in rules.items()}
    seen = rows.observe(observed, F.count(F.lit(1)).alias("rows"), *[F.count_if(b).alias(code) for code, b in broken.items()])
    text = lambda m: m if isinstance(m, Column) else F.lit(m)
    found = F.array_compact(F.array(*[F.when(broken[code], F.struct(F.lit(code).alias("code"), F.lit(r.severity).alias("severity"), text(r.message).alias("message"))) for code, r in rules.items()]))
    return seen.select(*target, F.col(ref).cast("string").alias("ref"), F.explode(found).alias("x")).select(*target, "ref", "x.*"), observed


def report(findings: DataFrame, target: Sequence[str]) -> DataFrame:
    """(target columns, code, severity, n, first_ref, status): findings counted by target; status is the target's worst severity.

    The counts are partial aggregates; a target's status comes from them, so no target's findings meet in one task.
    """
    n = findings.groupBy(*target, "code", "severity").agg(F.count("*").alias("n"), F.min("ref").alias("first_ref"))
    worst = n.groupBy(*target).agg(F.when(F.max(F.col("severity") == "FAIL"), "FAIL").otherwise("WARN").alias("status"))
    return n.join(worst, list(target))


def document_keys(model: str, region: str, lang: str) -> Column:
    """The document keys that a row may have: model_region, and that with its language; none where model or region is blank."""
    base = F.concat_ws("_", model_token(F.trim(model), region), filled(region))
    known = F.nullif(model_token(F.trim(model), region), F.lit("")).isNotNull() & filled(region).isNotNull()
    return F.when(known, F.array_compact(F.array(base, F.when(filled(lang).isNotNull(), F.concat_ws("_", base, filled(lang))))))


def specification_rules(needs_value: Column | None = None) -> dict[str, Rule]:
    """Rules for the latest rows of a specification (document_key, Model, Region, Source_lang, Row_key, Row_label_source, Value_source).

    Rows without a Row_key are no rows of a document and break none. needs_value: where a value has to stand; everywhere by default.
    """
    row, said = filled("Row_key").isNotNull(), lambda text: F.concat(F.lit("row "), F.trim("Row_key"), F.lit(f" {text}"))
    lang, key, keys = filled("Source_lang"), filled("document_key"), document_keys("Model", "Region", "Source_lang")
    return {
        "missing_source_lang": Rule(row & lang.isNull(), message=said("has no source language")),
        "invalid_source_lang": Rule(row & ~F.lower(lang).isin(*SOURCE_LANGUAGES), message=said("has an unknown source language")),
        "missing_document_key": Rule(row & key.isNull(), message=said("has no document key")),
        "invalid_document_key": Rule(row & keys.isNotNull() & ~F.array_contains(keys, key), message=F.concat(said("has a document key other than "), F.array_join(keys, " or "))),
        "missing_source_row_label": Rule(row & filled("Row_label_source").isNull(), message=said("has no label")),
        "missing_source_value": Rule(row & (F.lit(True) if needs_value is None else needs_value) & filled("Value_source").isNull(), message=said("has no value")),
    }


def rows_of_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """rows with `target` for each target (target, model, region) that they belong to: latest rows of the target's model and region, or with its document key.

    Each of the two ways is an equi-join; a row that meets a target both ways stands once. Rows and targets with a blank
    model or region meet by document key alone, and not at all without one.
    """
    place = lambda m, r: F.concat_ws("\u0001", F.lower(model_token(F.trim(m), r)), F.lower(F.trim(r)))
    latest = rows.where(F.upper(F.trim("Is_Latest")).isin("TRUE", "1", "YES"))
    with_keys = targets.where(filled("model").isNotNull() & filled("region").isNotNull()).select("target", place("model", "region").alias("__place"), F.concat_ws("_", model_token(F.trim("model"), "region"), F.trim("region")).alias("__key"))
    own = filled("Model").isNotNull() & filled("Region").isNotNull()
    ways = F.array_compact(F.array(F.when(own, F.concat(F.lit("p"), place("Model", "Region"))), F.when(filled("document_key").isNotNull(), F.concat(F.lit("k"), F.trim("document_key")))))
    asked = with_keys.select("target", F.explode(F.array(F.concat(F.lit("p"), "__place"), F.concat(F.lit("k"), "__key"))).alias("__way")).distinct()
    each = latest.withColumn("__ways", ways).withColumn("__way", F.explode("__ways"))
    met = each.join(asked, "__way")
    # by document key only where the place does not meet the same target
    again = F.col("__way").startswith("k") & own & (F.get("__ways", F.lit(0)) == F.concat(F.lit("p"), F.col("__at")))
    met = met.join(with_keys.groupBy("target").agg(F.min("__place").alias("__at")), "target").where(~F.coalesce(again, F.lit(False)))
    return met.select("target", *rows.columns)
