"""Records by kind, staged values, cross-checks of assets, unions of sources, and audits by key.

All are joins on keys and partial aggregates; a set per key is collected only of what a key has few of (templates, pages,
languages, models, regions), never of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import SCRIPTS, filled, script_count
from tessera.operators.lookup import small, unique_or_abstain
from tessera.operators.quality import finding, order_collisions


def resolved_by_kind(requests: DataFrame, index: DataFrame, tables: dict[str, str], redirects: dict[str, str] | None = None) -> DataFrame:
    """(request_id, record_id, status) for requests (request_id, kind, key) against an index (table, key, record_id).

    A kind names its table; a redirected table is read in place of another. status: found, ambiguous, missing, or
    unknown_kind; only a key with one record is found.
    """
    to = {kind: (redirects or {}).get(t, t) for kind, t in tables.items()}
    table = F.coalesce(*[F.when(F.col("kind") == k, F.lit(t)) for k, t in to.items()], F.lit(None).cast("string"))
    known = unique_or_abstain(index, ["table", "key"], "record_id").select("table", "key", "record_id", F.col("status").alias("s"))
    asked = requests.withColumn("table", table)
    status = F.when(F.col("table").isNull(), "unknown_kind").when(F.col("s").isNull(), "missing").when(F.col("record_id").isNull(), "ambiguous").otherwise("found")
    return asked.join(known, ["table", "key"], "left").select("request_id", "record_id", status.alias("status"))


def records_of_row(requests: DataFrame, index: DataFrame, mark: str = "|") -> DataFrame:
    """(request_id, record_id): every record whose key is the row's key and one further part after the mark."""
    rows = index.where(F.col("key").contains(mark)).select(F.call_function("substring_index", F.col("key"), F.lit(mark), F.size(F.split("key", f"[{mark}]")) - 1).alias("row_key"), "record_id")
    return requests.select("request_id", F.col("key").alias("row_key")).join(rows, "row_key").select("request_id", "record_id").distinct()


def row_variables(asked: DataFrame, given: DataFrame, table: DataFrame) -> DataFrame:
    """asked (row_id, variable) with value and origin: of the variables given (variable, value; letter case aside), else of
    the table's (variable, value), else null. The least value counts where one side has several."""
    one = lambda df, key, name: df.groupBy(key.alias("__k")).agg(F.min("value").alias(name)).where(filled(name).isNotNull())
    first, second = one(given, F.lower("variable"), "__g"), one(table, F.col("variable"), "__t")
    joined = asked.join(first, F.lower("variable") == first["__k"], "left").drop("__k").join(second, F.col("variable") == second["__k"], "left")
    origin = F.when(F.col("__g").isNotNull(), "given").when(F.col("__t").isNotNull(), "table").otherwise("none")
    return joined.select(*asked.columns, F.coalesce("__g", "__t").alias("value"), origin.alias("origin"))


def staged(current: DataFrame, sibling: DataFrame, candidate: DataFrame, override: DataFrame) -> DataFrame:
    """(key, value, origin) of a staging table: an override, else a filled candidate, else the current value, else the
    sibling's. Each input is (key, value); a key of any of them is in the result, the least value of repeats counts."""
    layers = (("override", override), ("candidate", candidate), ("current", current), ("sibling", sibling))
    each = reduce(DataFrame.unionByName, [df.where(filled("value").isNotNull()).select("key", F.lit(i).alias("rank"), F.lit(name).alias("origin"), "value") for i, (name, df) in enumerate(layers)])
    keys = reduce(DataFrame.unionByName, [df.select("key") for _, df in layers]).distinct()
    best = each.groupBy("key").agg(F.min(F.struct("rank", "value", "origin")).alias("m"))
    return keys.join(best, "key", "left").select("key", "m.value", F.coalesce("m.origin", F.lit("none")).alias("origin"))


def asset_crosscheck(expected: DataFrame, printed: DataFrame, assets: DataFrame, key: str) -> DataFrame:
    """(key, issue): expected and not printed, printed and not expected, printed without an asset."""
    e, p, a = (df.select(key).where(filled(key).isNotNull()).distinct() for df in (expected, printed, assets))
    parts = [e.join(p, key, "left_anti").withColumn("issue", F.lit("not_printed")), p.join(e, key, "left_anti").withColumn("issue", F.lit("not_expected")), p.join(a, key, "left_anti").withColumn("issue", F.lit("no_asset"))]
    return reduce(DataFrame.unionByName, parts)


def one_queue(sources: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The rows of several queue tables as one: queue_scope and the common columns, absent ones null text."""
    shaped = [df.select(F.lit(scope).alias("queue_scope"), *[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns]) for scope, df in sources.items()]
    return reduce(DataFrame.unionByName, shaped)


def concatenated(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of all sources with `source`; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source", F.lit(name)) for name, df in sources.items()])


def signal_words(requests: DataFrame, entries: DataFrame, fallback: str = "en") -> DataFrame:
    """(request_id, label): of entries (word, lang, label) the request's (request_id, word, lang): its language's, else its base
    language's (before the hyphen), else the fallback's; null without any."""
    asked = requests.select("request_id", F.upper(F.trim("word")).alias("word"), F.lower("lang").alias("own"))
    known = entries.select(F.upper(F.trim("word")).alias("word"), F.lower("lang").alias("lang"), "label").where(filled("label").isNotNull())
    found = asked.join(known, "word", "left")
    rank = F.when(F.col("lang") == F.col("own"), 0).when(F.col("lang") == F.substring_index("own", "-", 1), 1).when(F.col("lang") == fallback, 2)
    best = found.withColumn("rank", rank).groupBy("request_id").agg(F.min(F.when(F.col("rank").isNotNull(), F.struct("rank", "label"))).alias("m"))
    return best.select("request_id", "m.label")


def distinct_and_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row: how many different non-blank keys there are, and the sum of value over all rows."""
    per = df.groupBy(key).agg(F.sum(value).alias("v"))
    return per.agg(F.count_if(filled(key).isNotNull()).alias("keys"), F.coalesce(F.sum("v"), F.lit(0)).alias("total"))


def dashboard(faces: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(face, metric, name, value): every column of one-row tables, laid out by face and metric."""
    rows = []
    for face, metrics in faces.items():
        for metric, df in metrics.items():
            cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in df.columns])
            rows.append(df.select(F.lit(face).alias("face"), F.lit(metric).alias("metric"), F.explode(cells).alias("x")).select("face", "metric", "x.*"))
    return reduce(DataFrame.unionByName, rows)


def template_usage(rows: DataFrame, key: str, sets: Sequence[str], registry: DataFrame) -> DataFrame:
    """(key, n, one sorted array of distinct non-blank values for each of sets, registered): how a key is used, left-joined
    to the registry of known keys."""
    used = rows.where(filled(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"), *[F.sort_array(F.collect_set(filled(c))).alias(c) for c in sets])
    return used.join(registry.select(key).distinct().withColumn("registered", F.lit(True)), key, "left").withColumn("registered", F.coalesce("registered", F.lit(False)))


def alias_lists(pairs: DataFrame, key: str, alias: str) -> DataFrame:
    """(key, aliases): the different filled aliases of a key in order, its own name left out."""
    fine = pairs.where(filled(key).isNotNull() & filled(alias).isNotNull() & (F.trim(alias) != F.trim(key)))
    return fine.groupBy(key).agg(F.sort_array(F.collect_set(F.trim(alias))).alias("aliases"))


def localized_value(base: str, lang: Column, source_lang: Column, columns: dict[str, str]) -> Column:
    """A row's text in a language: the source column where that is the row's own, else the language's column, else the source's.

    columns: language to its column; base: the source column."""
    own = F.lower(F.trim(lang)) == F.lower(F.trim(source_lang))
    other = F.coalesce(*[F.when(F.lower(F.trim(lang)) == code.lower(), filled(c)) for code, c in columns.items()], F.lit(None).cast("string"))
    return F.when(own, filled(base)).otherwise(F.coalesce(other, filled(base)))


def page_value(value: Column, label: Column, kind: Column, exceptions: Sequence[str]) -> Column:
    """The text of a page value: none of a note; the label where that is one of the exceptions; else the value, else the label."""
    return F.when(F.lower(kind) == "note", F.lit(None)).when(F.lower(F.trim(label)).isin(*[e.lower() for e in exceptions]), filled(label)).otherwise(F.coalesce(filled(value), filled(label)))


def bound_placeholders(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with `placeholder`: names (row_key, slot, placeholder) of the same slot, else of the row's blank slot."""
    known = names.select("row_key", F.coalesce(filled("slot"), F.lit("")).alias("__s"), "placeholder").groupBy("row_key", "__s").agg(F.min("placeholder").alias("p"))
    exact = known.where("__s <> ''").select("row_key", F.col("__s").alias("slot"), F.col("p").alias("__a"))
    wide = known.where("__s = ''").select("row_key", F.col("p").alias("__b"))
    return rows.join(exact, ["row_key", "slot"], "left").join(wide, "row_key", "left").select(*rows.columns, F.coalesce("__a", "__b").alias("placeholder"))


def is_title(key: Column, kind: Column, latest: Column) -> Column:
    """A latest copy row of a section title."""
    return F.coalesce(F.lower(kind).isin("title", "section_title") & F.lower(key).rlike(r"(^|[._])title$") & F.lower(latest).isin("1", "true", "yes", "y"), F.lit(False))


def filled_fields(c: Column) -> Column:
    """A map without its null and blank values."""
    return F.map_filter(c, lambda _, v: F.coalesce(F.trim(v), F.lit("")) != "")


def named_fields(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """df with columns called by field id under the fields' names; an id without a name keeps it, and of two ids of one name
    the first filled one counts."""
    by: dict[str, list[str]] = {}
    for c in df.columns:
        by.setdefault(names.get(c, c), []).append(c)
    return df.select(*[(F.coalesce(*[filled(c) for c in ids]) if len(ids) > 1 else F.col(f"`{ids[0]}`")).alias(name) for name, ids in by.items()])


def config_targets(spark: SparkSession, path: str, keys: Sequence[str] = ("model", "region")) -> DataFrame:
    """Distinct targets of config files: one row for each file that sets all keys in lines `key: value` at the left margin."""
    line = F.lit(r"(?m)^([A-Za-z_]+):[ \t]*['\"]?([^'\"#\n]*)")
    pairs = F.zip_with(F.regexp_extract_all("value", line, 1), F.regexp_extract_all("value", line, 2), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    read = spark.read.text(path, wholetext=True).select(pairs.alias("x"))
    pick = lambda k: F.trim(F.get(F.filter("x", lambda e: e["k"] == k), F.lit(0))["v"])
    found = read.select(*[filled(pick(k)).alias(k) for k in keys])
    return found.dropna().distinct()


def snapshot_root(exists: Sequence[tuple[str, bool]]) -> str | None:
    """The first folder that is there, of (path, exists) in the order explicit, active, legacy; None without any."""
    return next((p for p, there in exists if p and there), None)


def section_audit(rows: DataFrame, scope: Sequence[str], section: str, order: str, text: str, slot: str, lang: str, ref: str) -> DataFrame:
    """Findings on specification sections: orders that sections share, exact repeats, text in the wrong script, malformed slot
    keys, and values that look unfinished."""
    same = [*scope, section, order, text]
    told = [x for c in same for x in (F.col(c).isNull(), F.col(c))]
    marked = rows.withColumn("__h", F.xxhash64(*told))
    first = marked.groupBy("__h").agg(F.min(ref).alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    again = marked.join(first, "__h").where(F.col(ref) > F.col("__first"))
    latin = script_count(text, "latin") > 0
    wrong = rows.where(F.lower(F.col(lang)).isin("zh", "ja", "ko") & latin & ~reduce(lambda a, b: a | b, [F.col(text).rlike(f"[{SCRIPTS[s]}]") if s in SCRIPTS else F.lit(False) for s in ("han", "kana", "hangul")]))
    bad_slot = rows.where(filled(slot).isNotNull() & ~F.trim(F.col(slot)).rlike(r"^[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+){0,2}$"))
    suspect = rows.where(F.col(text).rlike(r"(?i)\b(tbd|todo|xxx)\b|\?\?"))
    parts = [
        order_collisions(rows, scope, order, section), finding(again, "exact_repeat", "WARN", ref, "row repeats an earlier one", evidence={"first": F.col("__first")}), finding(wrong, "script_mismatch", "WARN", ref, "text is in another script", text, lang),
        finding(bad_slot, "bad_slot_key", "FAIL", ref, "slot key is malformed", slot), finding(suspect, "suspect_value", "WARN", ref, "value looks unfinished", text),
    ]
    return reduce(DataFrame.unionByName, parts)


def footnote_issues(notes: DataFrame, refs: DataFrame) -> DataFrame:
    """(scope, footnote_id, code) for footnotes (scope, footnote_id, ord, lang, text) and references (scope, footnote_id).

    Codes: missing id, order or language, unknown language, text with a marker of its own, repeated id, repeated order,
    unknown reference, and footnotes that nothing refers to."""
    row = {
        "missing_footnote_id": filled("footnote_id").isNull(), "missing_footnote_order": filled("ord").isNull(), "missing_footnote_source_lang": filled("lang").isNull(),
        "invalid_footnote_source_lang": ~F.lower(F.trim("lang")).isin("en", "zh", "ja", "fr", "es", "pt-br", "de", "it", "uk", "ko"), "footnote_text_contains_marker": F.col("text").rlike("^[\\s]*[①-⑳*]"),
    }
    coded = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(code)) for code, bad in row.items()]), lambda c: c.isNotNull())
    parts = [notes.select("scope", "footnote_id", F.explode(coded).alias("code"))]
    fine = notes.where(filled("footnote_id").isNotNull())
    twice = fine.groupBy("scope", "footnote_id").count().where("count > 1").select("scope", "footnote_id", F.lit("duplicate_footnote_id").alias("code"))
    ranks = fine.where(filled("ord").isNotNull()).groupBy("scope", "ord").agg(F.min("footnote_id").alias("footnote_id"), F.max("footnote_id").alias("hi")).where("footnote_id <> hi")
    parts += [twice, ranks.select("scope", "footnote_id", F.lit("duplicate_footnote_order").alias("code"))]
    have, used = fine.select("scope", "footnote_id").distinct(), refs.where(filled("footnote_id").isNotNull()).select("scope", "footnote_id").distinct()
    parts += [used.join(have, ["scope", "footnote_id"], "left_anti").withColumn("code", F.lit("unknown_footnote_ref")), have.join(used, ["scope", "footnote_id"], "left_anti").withColumn("code", F.lit("unused_footnote"))]
    return reduce(DataFrame.unionByName, parts)


def selector_issues(rows: DataFrame, required: DataFrame) -> DataFrame:
    """(scope, row_key, code) for latest rows (scope, row_key, slot, value) and required keys (row_key).

    Codes: several latest rows of one slot; of a required key no row, only blank values, or some blank ones; and a key whose
    blank slot has different values."""
    per = rows.groupBy("scope", "row_key").agg(F.count("*").alias("n"), F.count_if(filled("value").isNull()).alias("blank"))
    slots = rows.groupBy("scope", "row_key", F.coalesce(filled("slot"), F.lit("")).alias("s")).agg(F.count("*").alias("n"), F.min(filled("value")).alias("lo"), F.max(filled("value")).alias("hi"))
    code = lambda df, name: df.select("scope", "row_key", F.lit(name).alias("code")).distinct()
    need = required.select("row_key").distinct()
    held = per.join(need, "row_key")
    # only documents that lack some required key are set against all of them, by the keys' numbers
    listed = need.withColumn("no", F.row_number().over(W.orderBy("row_key")).cast("long"))
    full = held.groupBy("scope").agg(F.count("*").alias("have"))
    short = rows.select("scope").distinct().join(full, "scope", "left").withColumn("all", listed.agg(F.count("*")).scalar()).where(F.coalesce("have", F.lit(0)) < F.col("all"))
    wanted = short.select("scope", F.explode(F.sequence(F.lit(1).cast("long"), "all")).alias("no")).join(listed, "no").select("scope", "row_key")
    return reduce(DataFrame.unionByName, [
        code(slots.where("n > 1"), "duplicate_latest_spec_row"), code(held.where("blank = n"), "empty_required_spec_value"), code(held.where("blank > 0 and blank < n"), "partial_empty_spec_value"),
        code(slots.where("s = '' and lo <> hi"), "ambiguous_spec_selector"), code(wanted.join(per, ["scope", "row_key"], "left_anti"), "missing_required_spec_row"),
    ])


def config_issues(config: DataFrame, rules: DataFrame) -> DataFrame:
    """(target, key, code) for settings (target, key, value) under rules (key, kind, least, most, required).

    Codes: unknown_key, missing, not_a_number, out_of_range; kind is number or text."""
    seen = config.join(small(rules.select("key", "kind", "least", "most").withColumn("known", F.lit(True))), "key", "left")
    number = F.col("value").try_cast("double")
    code = F.when(F.col("known").isNull(), "unknown_key").when((F.col("kind") == "number") & number.isNull(), "not_a_number").when((F.col("kind") == "number") & ((number < F.col("least")) | (number > F.col("most"))), "out_of_range")
    bad = seen.select("target", "key", code.alias("code")).where("code is not null")
    needed = rules.where("required").agg(F.collect_set("key")).scalar()  # one list of the keys that every target has to have
    want = config.select("target").distinct().withColumn("__needed", needed).select("target", F.explode("__needed").alias("key"))
    return bad.unionByName(want.join(config.where(filled("value").isNotNull()).select("target", "key"), ["target", "key"], "left_anti").withColumn("code", F.lit("missing")))


def doctor(states: DataFrame, targets: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """(subject, code): snapshot tables (table, state) that are not ok, then targets without any row."""
    sick = states.where("state <> 'ok'").select(F.col("table").alias("subject"), F.concat(F.lit("snapshot_"), "state").alias("code"))
    bare = targets.select(*on).distinct().join(rows.select(*on), list(on), "left_anti").select(F.concat_ws("/", *on).alias("subject"), F.lit("no_rows").alias("code"))
    return sick.unionByName(bare)


def strict_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df; running it fails, with the key named, where a key stands twice. For writers that must not guess."""
    n = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    said = F.concat(F.lit("several rows of key "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    checked = n.where(F.when(F.col("__n") > 1, F.raise_error(said).cast("boolean")).otherwise(True)).select(*keys)
    return df.join(checked, list(keys), "left_semi")


def corpus_statistics(df: DataFrame, file: str, content: str, target: Column, tier: str, passed: Column) -> DataFrame:
    """One row: files, different contents, different targets, rows of each tier's share at most, and the rate of cells passed."""
    tiers = df.groupBy(tier).agg(F.count("*").alias("n"), F.count_if(passed).alias("ok"))
    total = tiers.agg(F.sum("n").alias("rows"), F.max("n").alias("largest"), F.sum("ok").alias("ok"))
    count = lambda c: df.select(c.alias("v")).where("v is not null").distinct().agg(F.count("*")).scalar()
    return total.select("rows", F.round(F.col("largest") / F.col("rows"), 4).alias("largest_tier"), F.round(F.col("ok") / F.col("rows"), 4).alias("pass_rate"), count(F.col(file)).alias("files"), count(F.col(content)).alias("contents"), count(target).alias("targets"))
