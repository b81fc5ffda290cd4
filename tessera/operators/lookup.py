"""Lookups: best match, unique match or abstention, latest version, fallback probes, containment.

The best row of a key is an aggregate (max_by over an ordering struct), not a window: partial results are
combined before the shuffle, so that a key with a third of all rows costs one row per task. Windows are used
only where every rank is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import collapsed, filled, tokens
from tessera.functions.values import flag, version_key
from tessera.operators.predicates import applies, page_applies


def small(df: DataFrame, most: int = 50_000, most_bytes: int = 64 << 20) -> DataFrame:
    """df, marked for broadcast if it is measured to have at most `most` rows and most_bytes of text; a larger one is left to the planner.

    For rule and copy tables that join on few keys: without it, all rows of a fact table meet in those keys' partitions.
    """
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns])
    n, held = df.limit(most + 1).agg(F.count("*"), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= most and held <= most_bytes else df


def best_per_key(df: DataFrame, keys: Sequence[str], better: Sequence[Column], pos: str, found_at: str | None = None) -> DataFrame:
    """The row of each key that is greatest by `better`, the earliest (least pos) of equals; all columns of df.

    found_at: a column to add with the key's first pos, for output in order of first appearance. Null keys are
    a key; null measures are least.
    """
    order = F.struct(*[b.alias(f"b{i}") for i, b in enumerate(better)], (-F.col(pos)).alias("early"))
    whole = F.struct(*[F.col(c) for c in df.columns])
    extra = [F.min(pos).alias(found_at)] if found_at else []
    return df.groupBy(*keys).agg(F.max_by(whole, order).alias("__row"), *extra).select("__row.*", *([found_at] if found_at else []))


def document_key(key: str = "document_key", doc_id: str = "document_id", record: str = "record_id") -> Column:
    """The key that versions of a document share: its own, or its id less a trailing version (of three parts or
    more), or the id, or the record's."""
    parts = F.split(F.col(doc_id), "_")
    last = F.element_at(parts, -1)
    bare = F.when((F.size(parts) >= 3) & last.rlike(r"^[vV]?\d+(\.\d+)*$"), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "_"))
    return F.coalesce(filled(key), filled(bare), filled(doc_id), F.col(record))


def latest_documents(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """One queue row per document: highest version, then ready, with a link, successful; ties keep the earliest.

    rows: document_key, document_id, record_id, version, delivery_ready boolean, delivery_url, result, pos.
    """
    named = rows.withColumn("latest_key", document_key())
    own = F.coalesce(filled("version"), F.regexp_extract(F.coalesce("document_id", F.lit("")), r"_([vV]?\d+(?:\.\d+)*)$", 1))
    better = [version_key(own), F.coalesce("delivery_ready", F.lit(False)), filled("delivery_url").isNotNull(), F.coalesce(F.lower("result").contains("success"), F.lit(False))]
    return best_per_key(named, ["latest_key"], better, pos, "first_pos")


def limited(df: DataFrame, order: Sequence[Column | str], limit: int = 10) -> DataFrame:
    """The first `limit` rows with matched_count (all rows), returned_count and truncated. The count is a scalar
    aggregate beside a top-k, so no window spans the table."""
    total = df.agg(F.count("*").alias("matched_count"))
    top = df.orderBy(*order).limit(max(limit, 0))
    found = top.withColumn("matched_count", total.scalar())
    returned = F.least(F.col("matched_count"), F.lit(limit))
    return found.withColumn("returned_count", returned).withColumn("truncated", F.col("matched_count") > limit)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Every row with its rank under its key, from 1."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def specificity(model: str, region: str, target_model: Column | str, target_region: Column | str, value: Column | str, latest: Column | str) -> Column:
    """How closely a row fits a target: 8 for the model and 8 for the region if named and met, 2 if neither side
    names a region, 2 for a value in the language asked for, 1 for a latest mark of any kind."""
    goal_m, goal_r = filled(target_model), filled(target_region)
    m = F.when(filled(model).isNotNull() & goal_m.isNotNull() & applies(model, target_model, "spec", target_region), 8).otherwise(0)
    r = F.when(filled(region).isNotNull() & goal_r.isNotNull() & applies(region, target_region), 8).otherwise(0)
    return m + r + F.when(filled(region).isNull() & goal_r.isNull(), 2).otherwise(0) + F.when(filled(value).isNotNull(), 2).otherwise(0) + F.when(filled(latest).isNotNull(), 1).otherwise(0)


def spec_matches(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Specification rows that apply to each target, with score and rank.

    rows: row_key, model, region, page, is_latest, value, line; targets: target_id, row_key, model, region,
    pages array. An equi-join on row_key, then the predicates: rows that are not latest, not enabled for the model,
    region or page drop out.
    """
    t = targets.select("target_id", "row_key", F.col("model").alias("t_model"), F.col("region").alias("t_region"), F.col("pages").alias("t_pages"))
    fits = flag("is_latest", "spec") & applies("model", "t_model", "spec", F.coalesce(filled("t_region"), F.lit(""))) & applies("region", "t_region") & page_applies("page", F.col("t_pages"))
    found = t.join(small(rows), "row_key").where(fits).withColumn("score", specificity("model", "region", "t_model", "t_region", "value", "is_latest"))
    return ranked(found, ["target_id"], [F.desc("score"), F.col("line").asc()]).drop("t_pages")


def spec_values(matches: DataFrame) -> DataFrame:
    """(target_id, value, line, score): the first ranked match of each target that has a value."""
    best = matches.where(filled("value").isNotNull()).groupBy("target_id").agg(F.min_by(F.struct("value", "line", "score"), "rank").alias("m"))
    return best.select("target_id", "m.*")


def substitutions(rows: DataFrame) -> DataFrame:
    """(placeholder, value): the best value of each placeholder and line order, with _BOLD and _LOWER forms.

    rows: placeholder, line_order, value, score, line. Line orders over 1 get the suffix _N.
    """
    from tessera.functions.text import derived_forms

    number = F.regexp_replace(F.coalesce(filled("line_order"), F.lit("1")), r"\.0$", "")
    named = rows.where(filled("value").isNotNull()).withColumn("placeholder", F.when(number == "1", F.col("placeholder")).otherwise(F.concat_ws("_", "placeholder", number)))
    best = named.groupBy("placeholder").agg(F.max_by(F.trim("value"), F.struct("score", (-F.col("line")).alias("l"))).alias("value"))
    return best.select(F.explode(derived_forms("placeholder", "value")).alias("placeholder", "value"))


def unique_or_abstain(df: DataFrame, keys: Sequence[str], ref: str) -> DataFrame:
    """(keys, ref, status): a key's only ref, or null and 'ambiguous' where it has several different ones.

    The same ref twice is one. Null refs and keys with a blank part give nothing. Two aggregates, no lists.
    """
    fine = df.where(F.col(ref).isNotNull())
    for k in keys:
        fine = fine.where(filled(k).isNotNull())
    found = fine.groupBy(*keys).agg(F.min(ref).alias("__lo"), F.max(ref).alias("__hi"))
    same = F.col("__lo") == F.col("__hi")
    return found.select(*keys, F.when(same, F.col("__lo")).alias(ref), F.when(same, "unique").otherwise("ambiguous").alias("status"))


def fallback_disambiguation(df: DataFrame, keys: Sequence[str], more: Sequence[str], ref: str) -> DataFrame:
    """(keys, more, ref, status): where keys alone are ambiguous, keys with `more` are tried; 'fallback' marks those
    that this settles, 'ambiguous' those it does not."""
    first = unique_or_abstain(df, keys, ref)
    blank = [F.lit(None).cast(df.schema[m].dataType).alias(m) for m in more]
    settled = first.where("status = 'unique'").select(*keys, *blank, ref, "status")
    again = df.join(first.where("status = 'ambiguous'").select(*keys), list(keys), "left_semi")
    second = unique_or_abstain(again, [*keys, *more], ref).withColumn("status", F.when(F.col("status") == "unique", "fallback").otherwise("ambiguous"))
    return settled.unionByName(second)


def value_index(df: DataFrame, value: str, ref: Sequence[str]) -> DataFrame:
    """(norm, ref..., status): normalised value to the place it comes from; a second occurrence anywhere makes it ambiguous."""
    norm = df.withColumn("norm", collapsed(value)).where("norm <> ''")
    found = norm.groupBy("norm").agg(F.count("*").alias("n"), *[F.min(r).alias(r) for r in ref])
    one = F.col("n") == 1
    return found.select("norm", *[F.when(one, F.col(r)).alias(r) for r in ref], F.when(one, "unique").otherwise("ambiguous").alias("status"))


def ordered_probe(df: DataFrame, key: str, candidates: Column, index: DataFrame, ref: Sequence[str]) -> DataFrame:
    """(key, ref..., hit_at): each row's first candidate that the index knows as unique; later ones are not looked at."""
    each = df.select(key, F.posexplode(candidates).alias("hit_at", "norm"))
    hits = each.join(index.where("status = 'unique'"), "norm")
    best = hits.groupBy(key).agg(F.min_by(F.struct(*ref, "hit_at"), "hit_at").alias("m"))
    return best.select(key, "m.*")


def translation_index(memory: DataFrame, source_col: str, langs: Sequence[str]) -> DataFrame:
    """(norm, lang, text, conflict): translations by normalised source text, blanks filled from later rows.

    Two different non-blank texts for one key and language are a conflict (text null); see strict().
    """
    long = memory.select(collapsed(source_col).alias("norm"), F.explode(F.create_map(*[x for c in langs for x in (F.lit(c), collapsed(c))])).alias("lang", "text"))
    found = long.where("norm <> '' and text <> ''").groupBy("norm", "lang").agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
    return found.select("norm", "lang", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("text"), (F.col("lo") != F.col("hi")).alias("conflict"))


def strict(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """df, failing the query if a row is bad: for callers to whom ambiguity is an error."""
    check = F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.where(check)


def translated(rows: DataFrame, text: str, source_lang: str, index: DataFrame, langs: Sequence[str]) -> DataFrame:
    """rows exploded by language: lang, localized, missing. The source language keeps the source text; a miss does
    too and is marked missing."""
    asked = rows.withColumn("norm", collapsed(text)).withColumn("lang", F.explode(F.array(*map(F.lit, langs))))
    known = index.where("not conflict").select("norm", "lang", F.col("text").alias("__t"))
    own = F.lower(F.col("lang")) == F.lower(F.col(source_lang))
    joined = asked.join(known, ["norm", "lang"], "left")
    return joined.withColumn("localized", F.when(own, F.col(text)).otherwise(F.coalesce("__t", F.col(text)))).withColumn("missing", ~F.coalesce(own, F.lit(False)) & F.col("__t").isNull()).drop("__t", "norm")


def containment(hay: DataFrame, text: str, needles: DataFrame, needle_id: str, needle: str, most_bytes: int = 32 << 20) -> DataFrame:
    """hay with needle_id for every needle that stands in its text; blank needles match nothing.

    Needles are a query set: their bytes are counted first, and up to most_bytes go to the tasks as one automaton, which
    finds all of them in one pass over each text. More of them go by an equi-join on their first characters.
    """
    known = needles.select(F.col(needle_id).alias("__id"), F.col(needle).alias("__n")).where(filled("__n").isNotNull())
    if (known.agg(F.sum(F.octet_length("__n") + 64)).first()[0] or 0) > most_bytes:
        return _containment_by_grams(hay, text, known, needle_id)
    held = known.select("__n").distinct().withColumn("__k", F.xxhash64("__n"))
    shared = [r["__n"] for r in held.collect()]  # at most most_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for n in shared:
            automaton.add_word(n, n)
        if shared:
            automaton.make_automaton()
        for b in batches:
            found = [sorted({n for _, n in automaton.iter(t)}) if t and shared else [] for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(pa.string()))], [*b.schema.names[:-1], "__found"])

    asked = hay.select("*", F.col(text).cast("string").alias("__t"))
    hits = asked.mapInArrow(run, T.StructType([*hay.schema.fields, T.StructField("__found", T.ArrayType(T.StringType()))]))
    each = hits.select(*hay.columns, F.explode("__found").alias("__n"))
    return each.join(known.select("__n", F.col("__id").alias(needle_id)), "__n").select(*hay.columns, needle_id)


def _containment_by_grams(hay: DataFrame, text: str, known: DataFrame, needle_id: str) -> DataFrame:
    """Needles met at any place where their first eight characters (or all, if fewer) stand in the text."""
    width = 8
    sized = known.withColumn("w", F.least(F.lit(width), F.length("__n"))).withColumn("g", F.substr("__n", F.lit(1), F.col("w")))
    widths = [r["w"] for r in sized.select("w").distinct().collect()]  # at most eight rows
    keyed = hay.withColumn("__h", F.xxhash64(text))
    texts = keyed.select("__h", F.col(text).alias("__text")).distinct()
    grams = None
    for w in widths:
        starts = F.sequence(F.lit(1), F.length("__text") - w + 1)
        g = texts.where(F.length("__text") >= w).select("__h", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substr("__text", i, F.lit(w))))).alias("g"))  # noqa: B023
        g = g.withColumn("w", F.lit(w))
        grams = g if grams is None else grams.unionByName(g)
    pairs = grams.join(sized, ["w", "g"]).join(texts, "__h").where(F.contains("__text", "__n")).select("__h", "__text", F.col("__id").alias(needle_id)).distinct()
    joined = keyed.join(pairs, "__h").where(F.col(text) == F.col("__text"))
    return joined.select(*hay.columns, needle_id)


def variable_values(defaults: DataFrame, requests: DataFrame, overrides: DataFrame) -> DataFrame:
    """(request_id, variable, value, status): the default of the exact model, else the default row; then the
    language's override of that value.

    defaults: variable, models array, value, is_default boolean; requests: request_id, variable, model, lang;
    overrides: variable, lang, source_value, value. Several exact or several default rows are a 'duplicate'.
    """
    hits = requests.join(small(defaults), "variable").withColumn("exact", F.exists("models", lambda m: F.lower(m) == F.lower(F.col("model"))))
    tally = hits.groupBy("request_id", "variable", "lang").agg(
        F.count_if("exact").alias("n_exact"), F.max(F.when(F.col("exact"), F.col("value"))).alias("v_exact"),
        F.count_if(~F.col("exact") & F.col("is_default")).alias("n_default"), F.max(F.when(~F.col("exact") & F.col("is_default"), F.col("value"))).alias("v_default"),
    )
    n = F.when(F.col("n_exact") > 0, F.col("n_exact")).otherwise(F.col("n_default"))
    based = tally.withColumn("base", F.when(n == 1, F.coalesce("v_exact", "v_default"))).withColumn("status", F.when(n == 0, "missing").when(n > 1, "duplicate").otherwise("found"))
    known = overrides.groupBy("variable", "lang", "source_value").agg(F.min("value").alias("own"))
    joined = based.join(small(known.withColumnRenamed("source_value", "base")), ["variable", "lang", "base"], "left")
    missed = requests.join(based.select("request_id"), "request_id", "left_anti").select("request_id", "variable", F.lit(None).cast("string").alias("value"), F.lit("missing").alias("status"))
    return joined.select("request_id", "variable", F.coalesce("own", "base").alias("value"), "status").unionByName(missed)


def copy_texts(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, text, line, status) of localised copy: 2 points each for the model and the region, a versioned
    row before others, then the earliest; 'blank' if any row that could serve has no text, else 'missing'.

    rows: copy_key, region, model, is_latest, version, text, line; requests: request_id, copy_key, model, region.
    """
    asked = requests.select("request_id", "copy_key", F.col("model").alias("t_model"), F.col("region").alias("t_region"))
    own = F.lower(F.trim("region"))
    region_score = F.when(filled("region").isNull() | (own == "all"), 0).when(own == F.lower(F.trim("t_region")), 2)
    parts = tokens("model", r"[,;|/\s、，]+")
    model_score = F.when((F.size(parts) == 0) | F.exists(parts, lambda t: F.lower(t) == "all"), 0).when(applies("model", "t_model", "block_model", F.coalesce("t_region", F.lit(""))), 2)
    fit = asked.join(small(rows), "copy_key").where(flag("is_latest", "localized")).withColumn("score", region_score + model_score).where("score is not null")
    order = F.struct("score", filled("version").isNotNull().alias("v"), (-F.col("line")).alias("l"))
    best = fit.groupBy("request_id").agg(F.max_by(F.struct(F.trim("text").alias("text"), "line"), order).alias("m"), F.max(filled("text").isNull()).alias("blank"))
    found = best.select("request_id", F.when(~F.col("blank"), F.col("m.text")).alias("text"), F.when(~F.col("blank"), F.col("m.line")).alias("line"), F.when(F.col("blank"), "blank").otherwise("found").alias("status"))
    return requests.select("request_id").join(found, "request_id", "left").withColumn("status", F.coalesce("status", F.lit("missing")))


def footnotes(notes: DataFrame, refs: DataFrame, model: str, region: str, preferred_langs: Sequence[str] = ()) -> DataFrame:
    """Footnotes for a target: all rows that fit it exactly, and for each referenced (page, id) without one the
    best other row, if it is the only best one.

    notes: footnote_id, page, region, model, source_lang, line (text: lines are compared as text), is_latest;
    refs: page, footnote_id. Adds `how`: exact or fallback. Fallbacks look past the region and prefer rows without
    one, then without a model, then in a preferred language.
    """
    live = notes.where(flag("is_latest", "spec") & applies("model", F.lit(model), "spec", F.lit(region)))
    exact = live.where(applies("region", F.lit(region)))
    wanted = refs.where(filled("page").isNotNull() & filled("footnote_id").isNotNull()).select(F.trim("page").alias("r_page"), F.trim("footnote_id").alias("footnote_id")).distinct()
    on_page = page_applies("page", F.array("r_page"))
    open_ = wanted.join(exact.select("footnote_id", "page"), "footnote_id", "left").groupBy("r_page", "footnote_id").agg(F.max(F.coalesce(F.col("page").isNotNull() & on_page, F.lit(False))).alias("has")).where("not has").drop("has")
    lang = F.lit(0) if not preferred_langs else F.when(F.lower("source_lang").isin(*[x.lower() for x in preferred_langs]), 0).otherwise(1)
    score = F.struct(filled("region").isNotNull().alias("a"), filled("model").isNotNull().alias("b"), lang.alias("c"), F.coalesce(filled("line"), F.lit("0")).alias("d"))
    tried = live.join(open_, "footnote_id").where(on_page).withColumn("score", score)
    best = tried.groupBy("r_page", "footnote_id").agg(F.min("score").alias("least"))
    tied = tried.join(best, ["r_page", "footnote_id"]).where(F.col("score") == F.col("least"))
    row = F.struct(*[F.col(c) for c in notes.columns])
    sole = tied.select("r_page", "footnote_id", row.alias("row")).groupBy("r_page", "footnote_id").agg(F.count("*").alias("n"), F.first("row").alias("row")).where("n = 1")
    return exact.withColumn("how", F.lit("exact")).unionByName(sole.select("row.*").distinct().withColumn("how", F.lit("fallback")))


def best_or_default(entries: DataFrame, requests: DataFrame, key: str, dim: str, name: str) -> DataFrame:
    """(request_id, name): of the entries of a key the one for the request's own `dim`, else the one without, the
    least name of each; null where there is neither."""
    asked = requests.select("request_id", key, F.col(dim).alias("__t"))
    fit = asked.join(small(entries), key).where(filled(dim).isNull() | (F.lower(F.trim(dim)) == F.lower(F.trim("__t"))))
    best = fit.groupBy("request_id").agg(F.min_by(name, F.struct(filled(dim).isNull().alias("general"), F.col(name).alias("n"))).alias(name))
    return requests.select("request_id").join(best, "request_id", "left")


def base_and_override(assets: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, asset, scope, status): an asset's one scoped row that applies, else its base row (scope blank or
    ALL); two that apply are 'ambiguous'.

    assets: asset_key, scope, asset; requests: request_id, asset_key, model.
    """
    # a key's rows in one array, so that a request is settled in its own row: no rows a request times assets to sort
    by_key = small(assets.groupBy("asset_key").agg(F.collect_list(F.struct("asset", "scope")).alias("__rows")))
    general = lambda r: filled(r["scope"]).isNull() | (F.upper(F.trim(r["scope"])) == "ALL")
    met = requests.join(by_key, "asset_key", "left")
    own = F.filter("__rows", lambda r: ~general(r) & applies(r["scope"], F.col("model"), "asset"))
    held = met.select("request_id", own.alias("own"), F.filter("__rows", general).alias("base"))
    hits = held.select("request_id", F.when(F.size("own") > 0, F.col("own")).otherwise(F.coalesce("base", F.array())).alias("hits"))
    n, pick = F.size("hits"), F.when(F.size("hits") == 1, F.get("hits", F.lit(0)))
    return hits.select("request_id", pick["asset"].alias("asset"), pick["scope"].alias("scope"), F.when(n > 1, "ambiguous").when(n == 1, "found").otherwise("missing").alias("status"))


def candidate_actions(candidates: DataFrame, snapshot: DataFrame, keys: Sequence[str], narrow: Sequence[str], fields: Sequence[str], ref: str) -> DataFrame:
    """(candidate_id, action, ref, changed): create, update, noop or review for each intake candidate.

    Snapshot rows that share the keys are narrowed by each further column in turn, but only while more than one
    is left and only if that leaves some; several left are for review.
    """
    c = candidates.select("candidate_id", *keys, *[F.col(x).alias(f"__c_{x}") for x in (*narrow, *fields)])
    left = c.join(snapshot.select(*keys, ref, *narrow, *fields), list(keys))
    for x in narrow:
        same = F.coalesce(F.col(x) == F.col(f"__c_{x}"), F.lit(False))
        by = W.partitionBy("candidate_id")
        left = left.withColumn("__n", F.count("*").over(by)).withColumn("__hits", F.sum(same.cast("int")).over(by))
        left = left.where((F.col("__n") == 1) | (F.col("__hits") == 0) | same).drop("__n", "__hits")
    changed = F.array_join(F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__c_{f}")), F.lit(f)) for f in fields]), lambda f: f.isNotNull()), ",")
    found = left.withColumn("changed", changed).groupBy("candidate_id").agg(F.count("*").alias("n"), F.min(ref).alias(ref), F.min("changed").alias("changed"))
    joined = candidates.select("candidate_id").join(found, "candidate_id", "left")
    action = F.when(F.col("n").isNull(), "create").when(F.col("n") > 1, "review").when(F.col("changed") == "", "noop").otherwise("update")
    return joined.select("candidate_id", action.alias("action"), F.when(F.col("n") == 1, F.col(ref)).alias(ref), F.when(F.col("n") == 1, F.col("changed")).alias("changed"))


def label_keys(observed: DataFrame, existing: DataFrame, template: DataFrame) -> DataFrame:
    """(label, line_order, row_key): a key for every pair seen or mapped before: the mapping's own, else one that the
    mapping gives the label elsewhere, else the least observed. Blank labels are left out."""
    pairs = observed.select("label", "line_order").unionByName(existing.select("label", "line_order")).where(filled("label").isNotNull()).distinct()
    own = existing.where(filled("row_key").isNotNull()).groupBy("label", "line_order").agg(F.min("row_key").alias("a"))
    same = existing.where(filled("row_key").isNotNull()).groupBy("label").agg(F.min("row_key").alias("b"))
    seen = observed.join(template.select("row_key").distinct(), "row_key", "left_semi").where(filled("row_key").isNotNull()).groupBy("label", "line_order").agg(F.min("row_key").alias("c"))
    return pairs.join(own, ["label", "line_order"], "left").join(same, "label", "left").join(seen, ["label", "line_order"], "left").select("label", "line_order", F.coalesce("a", "b", "c", F.lit("")).alias("row_key"))


def skeleton(slots: DataFrame, langs: Sequence[str], mounted: DataFrame) -> DataFrame:
    """(lang, slot, part, item): every slot for every language, and compliance rows mounted behind their anchor slot.

    slots: slot, slot_order; mounted: anchor, lang, item. The languages are a fixed list, so this is an explode.
    """
    each = slots.withColumn("lang", F.explode(F.array(*map(F.lit, langs))))
    base = each.select("lang", "slot", "slot_order", F.lit(0).alias("part"), F.col("slot").alias("item"))
    more = each.join(mounted.withColumnRenamed("anchor", "slot"), ["slot", "lang"]).select("lang", "slot", "slot_order", F.lit(1).alias("part"), "item")
    return base.unionByName(more)


def refs_to_ids(rows: DataFrame, key: str, refs: str, known: DataFrame) -> DataFrame:
    """(key, ids, unresolved): a cell of comma-parted record ids as business ids in the cell's order, and those that
    `known` (record_id, business_id) lacks. Rows without references give empty texts."""
    each = rows.select(key, F.posexplode_outer(tokens(refs, ",")).alias("p", "record_id"))
    one = known.groupBy("record_id").agg(F.min("business_id").alias("b"))
    found = each.join(small(one), "record_id", "left")
    pairs = lambda c: F.array_join(F.transform(F.array_sort(F.filter(F.collect_list(F.struct("p", c.alias("v"))), lambda x: x["v"].isNotNull())), lambda x: x["v"]), ",")
    return found.groupBy(key).agg(pairs(F.col("b")).alias("ids"), pairs(F.when(F.col("b").isNull(), F.col("record_id"))).alias("unresolved"))


def memory_writes(suggestions: DataFrame, memory: DataFrame) -> DataFrame:
    """(delta_hash, record_id, status): write, already, ambiguous or missing for corrections of translations.

    suggestions: delta_hash, lang, old_text, new_text; memory: record_id, lang, text. The record of the old text, if it is
    the only one; without one, a record of the new text means that it is written already.
    """
    index = unique_or_abstain(memory.select("record_id", "lang", collapsed("text").alias("norm")), ["lang", "norm"], "record_id")
    side = lambda name: index.select("lang", F.col("norm").alias(f"{name}_norm"), F.col("record_id").alias(f"{name}_id"), F.col("status").alias(f"{name}_status"))
    asked = suggestions.select("delta_hash", "lang", collapsed("old_text").alias("old_norm"), collapsed("new_text").alias("new_norm"))
    both = asked.join(side("old"), ["lang", "old_norm"], "left").join(side("new"), ["lang", "new_norm"], "left")
    status = F.when(F.col("old_status") == "unique", "write").when(F.col("old_status") == "ambiguous", "ambiguous").when(F.col("new_status").isNotNull(), "already").otherwise("missing")
    return both.select("delta_hash", F.when(status == "write", F.col("old_id")).when((status == "already"), F.col("new_id")).alias("record_id"), status.alias("status"))


def seed_plan(slots: DataFrame, sources: DataFrame, key: str, ref: str) -> DataFrame:
    """(key, ref, status): what a new product line can copy: a slot's only source, else needs_input."""
    found = unique_or_abstain(sources, [key], ref)
    joined = slots.select(key).distinct().join(found, key, "left")
    return joined.select(key, ref, F.when(F.col("status") == "unique", "copy").otherwise("needs_input").alias("status"))


def narrowed(langs: Column, scope: Column) -> Column:
    """Languages that a product's scope allows, in their own order; all of them where the scope is null or empty."""
    return F.when(F.coalesce(F.size(scope) == 0, F.lit(True)), langs).otherwise(F.filter(langs, lambda x: F.exists(scope, lambda s: F.lower(s) == F.lower(x))))


def allowed_pages(pages: DataFrame, capabilities: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (document_key, page) without those that a capability the product lacks forbids; products without a
    capability row keep all. capabilities: document_key, capability, has; rules: capability, page, forbidden."""
    barred = capabilities.where("not has").join(small(rules.where("forbidden")), "capability").select("document_key", "page").distinct()
    return pages.join(barred, ["document_key", "page"], "left_anti")
