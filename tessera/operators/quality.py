"""Quality rules. Every rule is a DataFrame of findings in one long form, so that reports are a union."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import SCRIPTS, collapsed, display_width, filled, inline_norm, outside, script_count, tokens
from tessera.functions.udfs import content_hash, partial_ratio
from tessera.operators.lookup import containment, small

#: The columns of a finding.
FINDING = ("rule", "severity", "ref", "field", "lang", "message", "evidence")


def finding(df: DataFrame, rule: str, severity: str | Column, ref: Column | str, message: Column | str, field: Column | str | None = None, lang: Column | str | None = None, evidence: dict[str, Column] | None = None) -> DataFrame:
    text = lambda c: F.lit(None).cast("string") if c is None else (c if isinstance(c, Column) else F.col(c)).cast("string")
    shown = F.to_json(F.struct(*[c.alias(k) for k, c in sorted((evidence or {}).items())])) if evidence else F.lit("{}")
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return df.select(F.lit(rule).alias("rule"), level.alias("severity"), text(ref).alias("ref"), text(field).alias("field"), text(lang).alias("lang"), (message if isinstance(message, Column) else F.lit(message)).alias("message"), shown.alias("evidence"))


def hashed(findings: DataFrame) -> DataFrame:
    """Adds finding_hash, of the canonical JSON of what identifies a finding."""
    return findings.withColumn("finding_hash", content_hash(F.to_json(F.struct("rule", "ref", "field", "lang", "evidence"))))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def without_known(findings: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Findings but for the accepted exceptions; a blank cell of an exception stands for any value of its column."""
    k = known.select(*[filled(c).alias(f"k_{c}") for c in on]).distinct()
    must = [c for c in on[:1]]
    cond = [F.col(c) == F.col(f"k_{c}") for c in must] + [F.col(f"k_{c}").isNull() | (F.col(c) == F.col(f"k_{c}")) for c in on[1:]]
    return findings.join(k, cond, "left_anti")


def severity_counts(findings: DataFrame) -> DataFrame:
    """(rule, severity, n) and, for each rule, its worst severity."""
    n = findings.groupBy("rule", "severity").agg(F.count("*").alias("n"))
    worst = findings.groupBy("rule").agg(F.max(F.when(F.col("severity") == "FAIL", 2).when(F.col("severity") == "WARN", 1).otherwise(0)).alias("w"))
    return n.join(worst, "rule").select("rule", "severity", "n", F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")), F.col("w") + 1).alias("status"))


def status_prefixes(rows: DataFrame, ref: str, text: str, words: Sequence[str], longest: int = 24) -> DataFrame:
    """Lines that begin like 'Label: ...' with a short label that is no known status word (letter case aside).

    The whole label has to be a known word, but for white space before the colon.
    """
    lines = rows.select(ref, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n")).alias("line"))
    prefix = F.regexp_replace(F.regexp_extract("line", r"^([^:：]*)[:：]", 1), r"^[\s\u00a0\u2009\u202f]+|[\s\u00a0\u2009\u202f]+$", "")
    known = [w.strip().lower() for w in words if w.strip()]
    odd = lines.withColumn("prefix", prefix).where((F.length("prefix") > 0) & (F.length("prefix") <= longest) & ~F.lower("prefix").isin(*known))
    return finding(odd, "status_word_consistency", "FAIL", ref, "line starts with an unknown status word", field=F.lit(text), evidence={"prefix": F.col("prefix")})


def residue(rows: DataFrame, ref: str, columns: dict[str, str], words: Sequence[str]) -> DataFrame:
    """Words of another language left in a translated column; columns: language to column."""
    each = rows.select(ref, F.explode(F.array(*[F.struct(F.lit(lang).alias("lang"), F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("")).alias("text")) for lang, c in columns.items()])).alias("x")).select(ref, "x.*")
    hits = each.withColumn("word", F.explode(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.col("text"), w))))
    return finding(hits, "english_residue", "WARN", ref, "untranslated word", "field", "lang", {"word": F.col("word")})


def terminology(rows: DataFrame, ref: str, text: str, lang: str, rules: DataFrame) -> DataFrame:
    """Deprecated terms by rule (rule_id, lang, deprecated_regex, allow_regex, preferred), outside what is allowed.

    Rules of any number, met by language; each text is read once for each rule of its language.
    """
    listed = rules.select(F.lower("lang").alias("__lang"), "rule_id", "deprecated_regex", "allow_regex", "preferred")
    met = rows.select(F.col(ref).alias("__ref"), F.col(lang).alias("__said"), F.col(text).alias("__text")).join(small(listed), F.lower("__said") == F.col("__lang"))
    each = met.select("__ref", F.col("__said").alias("__lang"), "rule_id", "preferred", F.explode(outside("__text", F.col("deprecated_regex"), F.col("allow_regex"))).alias("hit"))
    return finding(each, "terminology", "WARN", "__ref", F.concat(F.lit("use "), F.col("preferred")), F.lit(text), "__lang", {"rule_id": F.col("rule_id"), "hit": F.col("hit")})


def script_mismatch(rows: DataFrame, ref: str, text: str, lang: str, scripts: dict[str, str], least: float = 0.5) -> DataFrame:
    """Texts with less than `least` of their letters in the script of their language; texts without letters pass."""
    letters = reduce(lambda a, b: a + b, [script_count(text, s) for s in SCRIPTS])
    wanted = F.lit(None).cast("int")
    for code, script in scripts.items():
        wanted = F.when(F.lower(F.col(lang)) == code, script_count(text, script)).otherwise(wanted)
    bad = rows.where((letters > 0) & (wanted < least * letters))
    return finding(bad, "script_mismatch", "WARN", ref, "text is not in the script of its language", F.lit(text), lang, {"letters": letters, "wanted": wanted})


def foreign_identity(rows: DataFrame, ref: str, text: str, owner: str, names: DataFrame) -> DataFrame:
    """Names of other products in a text, its own product's names masked first, the longest first.

    names: owner, name, of any number; those of one owner are few. A row without an owner has no findings."""
    known = names.select("owner", "name").where(filled("name").isNotNull()).distinct()
    own = known.groupBy(F.col("owner").alias("__owner")).agg(F.array_sort(F.collect_list(F.struct((-F.length("name")).alias("n"), "name"))).alias("__own"))
    asked = rows.select(F.col(ref).alias("__ref"), F.col(owner).alias("__owner"), F.col(text).alias("__text")).where("__owner is not null")
    left = F.aggregate(F.coalesce("__own", F.array().cast("array<struct<n: int, name: string>>")), F.col("__text"), lambda t, x: F.replace(t, x["name"], F.lit(" ")))
    masked_rows = asked.join(small(own), "__owner", "left").select("__ref", "__owner", left.alias("__left"))
    owners = known.groupBy("name").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi"))
    found = containment(masked_rows, "__left", owners.select(F.col("name").alias("hit"), "name"), "hit", "name")
    hits = found.join(small(owners), F.col("hit") == F.col("name")).where("lo <> __owner or hi <> __owner")
    return finding(hits, "identity_drift", "FAIL", "__ref", "name of another product", F.lit(text), evidence={"name": F.col("hit")})


def repeated_renderings(rows: DataFrame, ref: str, left: Column, right: Column) -> DataFrame:
    """Items that only one of two renderings of a page shows."""
    each = rows.select(ref, F.explode(F.concat(F.transform(F.array_except(left, right), lambda t: F.struct(t.alias("t"), F.lit("left").alias("side"))), F.transform(F.array_except(right, left), lambda t: F.struct(t.alias("t"), F.lit("right").alias("side"))))).alias("x")).select(ref, "x.*")
    return finding(each, "rendering_drift", "WARN", ref, "only one rendering shows this", evidence={"text": F.col("t"), "side": F.col("side")})


def capability_pages(pages: DataFrame, capabilities: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages that a missing capability forbids or a present one requires and that are not there.

    pages: document_key, page; capabilities: document_key, capability, has boolean; rules: capability, page, required
    and forbidden booleans. A document without capability rows passes.
    """
    want = capabilities.join(rules, "capability")
    there = pages.select("document_key", "page").distinct().withColumn("there", F.lit(True))
    seen = want.join(there, ["document_key", "page"], "left").withColumn("there", F.coalesce("there", F.lit(False)))
    lacking = finding(seen.where("has and required and not there"), "capability_page", "FAIL", "document_key", "page of a capability is missing", "page", evidence={"capability": F.col("capability")})
    over = finding(seen.where("not has and forbidden and there"), "capability_page", "FAIL", "document_key", "page of a capability that the product lacks", "page", evidence={"capability": F.col("capability")})
    return lacking.unionByName(over)


#: Specification checks: code to (what a row has to meet, whether it fails the build).
SPEC_CHECKS: dict[str, tuple[Callable[[], Column], str]] = {
    "missing_source_lang": (lambda: filled("source_lang").isNotNull(), "FAIL"),
    "invalid_source_lang": (lambda: filled("source_lang").isNull() | F.lower(F.trim("source_lang")).isin("en", "zh", "ja", "fr", "es", "pt-br", "de", "it", "uk", "ko"), "FAIL"),
    "missing_row_key": (lambda: filled("row_key").isNotNull(), "FAIL"),
    "invalid_row_key": (lambda: filled("row_key").isNull() | F.trim("row_key").rlike("^[A-Za-z0-9_]+$"), "WARN"),
    "missing_label": (lambda: filled("label").isNotNull() | filled("param").isNotNull(), "FAIL"),
    "missing_value": (lambda: filled("value").isNotNull(), "FAIL"),
    "invalid_slot_key": (lambda: filled("slot_key").isNull() | F.trim("slot_key").rlike(r"^[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+){0,2}$"), "FAIL"),
    "invalid_section_order": (lambda: filled("section_order").isNull() | F.trim("section_order").rlike(r"^\d+(\.\d+)?$"), "WARN"),
    "invalid_line_order": (lambda: filled("line_order").isNull() | F.trim("line_order").rlike(r"^[1-9]\d*(\.0)?$"), "WARN"),
}


def spec_issues(rows: DataFrame, ref: str = "line") -> DataFrame:
    """A finding for every check that a specification row fails, in one pass over the rows."""
    failed = [F.when(~F.coalesce(ok(), F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, (ok, severity) in SPEC_CHECKS.items()]
    each = rows.select(ref, F.explode(F.filter(F.array(*failed), lambda x: x.isNotNull())).alias("x")).select(ref, "x.*")
    return finding(each, "spec_validation", F.col("severity"), ref, F.col("code"), evidence={"code": F.col("code")})


def unresolved_refs(rows: DataFrame, ref: str, refs: str, known: DataFrame, key: str) -> DataFrame:
    """References (a comma-parted cell) that the known keys lack."""
    each = rows.select(ref, F.explode(tokens(refs, ",")).alias("wanted"))
    return finding(each.join(known.select(F.col(key).alias("wanted")).distinct(), "wanted", "left_anti"), "unresolved_reference", "FAIL", ref, "reference to nothing", F.lit(refs), evidence={"wanted": F.col("wanted")})


def order_collisions(rows: DataFrame, scope: Sequence[str], order: str, name: str) -> DataFrame:
    """Orders that several differently named sections of a scope share."""
    g = rows.where(filled(order).isNotNull()).groupBy(*scope, order).agg(F.min(name).alias("lo"), F.max(name).alias("hi")).where("lo <> hi")
    return finding(g, "order_collision", "WARN", F.concat_ws("/", *scope), "sections share an order", F.lit(order), evidence={"order": F.col(order), "one": F.col("lo"), "other": F.col("hi")})


def repaired(rows: DataFrame, repairs: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """rows with `column` replaced by the repair list's value; repairs: the `on` columns and replacement."""
    r = repairs.groupBy(*on).agg(F.min("replacement").alias("__r"))
    return rows.join(r, list(on), "left").withColumn(column, F.coalesce("__r", column)).select(*rows.columns)


# Terms whose confusion a person has to confirm.
OUTPUT_TERMS = ("output", "outlet", "port")
BUTTON_TERMS = ("button", "switch", "key")


def _has(text: Column, terms: Sequence[str]) -> Column:
    return F.lower(text).rlike(r"\b(" + "|".join(terms) + r")s?\b")


def route(doc_type: Column, old: Column, new: Column, kind: Column, origin: Column, index_present: Column, family_targets: Column) -> Column:
    """(route, confidence) of a change: image asset, source table, needs a person, review or template text.

    origin: the table a value was resolved to, or null; family_targets: how many sibling documents share the text.
    """
    review = doc_type == "review"
    picture = r"^(\s*\[image\]\s*)+$"
    image = (F.coalesce(old, F.lit("[image]")).rlike(picture) & F.coalesce(new, F.lit("[image]")).rlike(picture))
    wordy = F.concat_ws(" ", old, new)
    looks = wordy.rlike(r"\{\{|\d+(\.\d+)?\s*(W|V|A|Wh|Ah|Hz|kg|mm|cm|in|°C|°F|℃|%)(?![A-Za-z])")
    data = (kind == "table_row") | (~index_present & looks)
    both = (old != "") & (new != "")
    risk = both & ((_has(old, OUTPUT_TERMS) & _has(new, BUTTON_TERMS) & ~_has(old, BUTTON_TERMS)) | (_has(old, BUTTON_TERMS) & _has(new, OUTPUT_TERMS) & ~_has(old, OUTPUT_TERMS)))
    verdict = lambda r, c: F.struct(F.lit(r).alias("route"), F.lit(c).alias("confidence"))
    return (
        F.when(image, verdict("image_asset_delta", "medium"))
        .when(origin.isNotNull() & review, verdict("source_table_suggestion", "high"))
        .when(origin.isNotNull(), verdict("needs_human_mapping", "low"))
        .when(data & review, verdict("source_table_suggestion", "medium"))
        .when(data, verdict("needs_human_mapping", "low"))
        .when(review & F.coalesce(risk, F.lit(False)), verdict("needs_human_mapping", "low"))
        .when(review & (F.coalesce(family_targets, F.lit(0)) > 1), verdict("needs_human_mapping", "medium"))
        .when(review, verdict("repo_review_text", "medium"))
        .otherwise(verdict("repo_template_text", "medium"))
    )


def verdicts(rows: DataFrame, machine: str = "machine_text", reviewer: str = "reviewer_text", hay: str = "haystack", threshold: float = 0.9, shortest: int = 12) -> DataFrame:
    """rows with `verdict`: accepted_as_proposed, rejected, edited_further or source_missing.

    Containment decides first. Only rows that it leaves open go to the fuzzy stage, in a branch of their own, since
    Spark does not promise to skip a UDF behind a condition. A blank reviewer text proposes a deletion.
    """
    read = rows.withColumn("__m", inline_norm(machine)).withColumn("__r", inline_norm(reviewer))
    h = F.col(hay)
    sure = (
        F.when(h.isNull(), "source_missing")
        .when((F.col("__r") == "") & ((F.col("__m") == "")), "accepted_as_proposed")
        .when((F.col("__r") == "") & F.contains(h, F.col("__m")), "rejected")
        .when((F.col("__r") == "") & (F.length("__m") < shortest), "accepted_as_proposed")
        .when((F.col("__r") != "") & F.contains(h, F.col("__r")), "accepted_as_proposed")
        .when((F.col("__r") != "") & (F.col("__m") != "") & F.contains(h, F.col("__m")), "rejected")
    )
    judged = read.withColumn("verdict", sure)
    done = judged.where("verdict is not null")
    open_ = judged.where("verdict is null").withColumn("__rr", partial_ratio("__r", hay)).withColumn("__mr", partial_ratio("__m", hay))
    long = lambda c: F.length(c) >= shortest
    rr, mr = F.when(long("__r"), F.col("__rr")).otherwise(0.0), F.when(long("__m"), F.col("__mr")).otherwise(0.0)
    fuzzy = (
        F.when(F.col("__r") == "", F.when(mr >= threshold, "rejected").otherwise("accepted_as_proposed"))
        .when((rr >= threshold) & (rr >= mr), "accepted_as_proposed").when(mr >= threshold, "rejected").otherwise("edited_further")
    )
    return done.unionByName(open_.withColumn("verdict", fuzzy).drop("__rr", "__mr")).drop("__m", "__r")


def reconciled(ledger: DataFrame, outcomes: DataFrame, sources: DataFrame) -> DataFrame:
    """A ledger with final_status filled in on pending rows, by route: table suggestions by the outcome of their write
    (delta_hash, status), review text by what the merged source (source_path, haystack) holds; others stay."""
    pending = F.coalesce(filled("final_status"), F.lit("pending")) == "pending"
    table = pending & (F.col("route_class") == "source_table_suggestion")
    text = pending & (F.col("route_class") == "repo_review_text")
    result = outcomes.groupBy("delta_hash").agg(F.max("status").alias("__s"))
    taken = F.when(F.col("__s").isin("written", "already_applied"), "accepted_as_proposed").when(F.col("__s").isNotNull(), "rejected")
    a = ledger.where(table).join(result, "delta_hash", "left").withColumn("final_status", F.coalesce(taken, F.lit("pending"))).select(*ledger.columns)
    b = verdicts(ledger.where(text).join(sources, "source_path", "left"))
    b = b.withColumn("final_status", F.when(F.col("verdict") == "source_missing", "pending").otherwise(F.col("verdict"))).select(*ledger.columns)
    rest = ledger.where(~F.coalesce(table | text, F.lit(False)))
    return rest.unionByName(a).unionByName(b)


def memory_candidates(ledger: DataFrame, pos: str = "pos") -> DataFrame:
    """(delta_hash, lang, old_text, new_text): accepted review corrections that change a text, the first of each hash."""
    new = F.coalesce(filled("final_text"), filled("reviewer_text"))
    fit = ledger.where((F.col("final_status") == "accepted_as_proposed") & (F.col("route_class") == "repo_review_text") & filled("lang").isNotNull() & filled("delta_hash").isNotNull() & filled("machine_text").isNotNull() & new.isNotNull())
    fit = fit.where(inline_norm("machine_text") != inline_norm(new))
    return fit.groupBy("delta_hash").agg(F.min_by(F.struct("lang", F.col("machine_text").alias("old_text"), new.alias("new_text")), pos).alias("m")).select("delta_hash", "m.*")


def document_sync(docs: DataFrame, baselines: DataFrame) -> DataFrame:
    """(doc, status): no_baseline, error, synced or pending by the hash last seen. docs: doc, hash, failed boolean."""
    b = baselines.groupBy("doc").agg(F.max("hash").alias("__b"))
    joined = docs.join(b, "doc", "left")
    status = F.when(F.coalesce("failed", F.lit(False)), "error").when(F.col("__b").isNull(), "no_baseline").when(F.col("hash") == F.col("__b"), "synced").otherwise("pending")
    return joined.select("doc", status.alias("status"))


def snippet_uses(files: DataFrame, path: str, text: str) -> DataFrame:
    """(snippet, file): distinct files that name a snippet as {{snippet:name}} or .. include:: name."""
    names = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"\{\{\s*snippet:([A-Za-z0-9_.-]+)\s*\}\}|\.\. include:: (\S+)"), 0)
    name = F.regexp_replace(F.col("hit"), r"^\{\{\s*snippet:|\s*\}\}$|^\.\. include:: ", "")
    return files.select(F.col(path).alias("file"), F.explode(names).alias("hit")).select(name.alias("snippet"), "file").distinct()


def bundle_issues(files: DataFrame, assets: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Unfilled placeholders, includes of files that are not there and pictures that are not there."""
    left = files.select(path, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{\{([A-Za-z0-9_]+)\}\}"), 1))).alias("name"))
    wanted = files.select(path, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?:\.\. (?:include|image|figure):: )(\S+)"), 1))).alias("name"))
    there = files.select(F.col(path).alias("name")).unionByName(assets.select(F.col("path").alias("name"))).distinct()
    a = finding(left, "unfilled_placeholder", "FAIL", path, "placeholder left", evidence={"name": F.col("name")})
    return a.unionByName(finding(wanted.join(there, "name", "left_anti"), "missing_file", "FAIL", path, "file is not there", evidence={"name": F.col("name")}))


def run_key(report: Column, most: int = 50) -> Column:
    """SHA-1 of a run's report, JSON text with a list `changes`: its other fields and the first changes, in canonical form."""
    from tessera.functions.udfs import canonical_json

    meta = F.filter(F.map_entries(F.from_json(report, "map<string,string>")), lambda e: e["key"] != "changes")
    first = F.slice(F.from_json(F.get_json_object(report, "$.changes"), "array<string>"), 1, most)
    return F.sha1(canonical_json(F.to_json(F.struct(F.map_from_entries(meta).alias("meta"), first.alias("changes")))))


def parameter_only(old: Column, new: Column) -> Column:
    """Whether two template texts differ in values of parameter lines (':name: value') alone: line by line the same
    names in the same places, and every other line equal."""
    shape = lambda t: F.regexp_replace(F.coalesce(t, F.lit("")), r"(?m)^(\s*:[A-Za-z0-9_-]+:).*$", "$1")
    return (shape(old) == shape(new)) & ~old.eqNullSafe(new)
