"""Relevance-scored top-k search. Scores are Column expressions; the top k is a TakeOrderedAndProject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import as_col, collapsed, filled, search_tokens
from tessera.functions.udfs import search_form_parts


def _count(tokens: Column, text: Column) -> Column:
    """How many of the tokens, repeats included, stand in a text."""
    return F.size(F.filter(tokens, lambda t: F.contains(text, t)))


def memory_score(query: Column, row_key: Column | str, source_text: Column | str, translations: Column, source_lang: str | None, target_lang: str | None, preferred_lang: str | None, blob: Column | None = None) -> Column:
    """The score of a translation-memory entry for a query; null drops it (a query none of whose tokens stand in it).

    translations: map of language to text. blob: all that is searched; by default source text, row key and translations.
    """
    low = lambda c: F.lower(collapsed(c))
    q, tokens, values = low(query), search_tokens(query), F.map_values(translations)
    all_text = F.lower(F.concat_ws(" ", collapsed(source_text), collapsed(row_key), F.array_join(values, " "))) if blob is None else F.lower(blob)
    src = low(translations[source_lang]) if source_lang else F.lit("")
    dst = low(translations[target_lang]) if target_lang else F.lit("")
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    hits, src_hits = _count(tokens, all_text), F.when(src != "", _count(tokens, src)).otherwise(0)
    exact = F.when((src != "") & (q == src), 180).when(q == low(source_text), 120).otherwise(0)
    asked = (
        exact + points(q == low(row_key), 110) + points(F.exists(values, lambda v: low(v) == q), 110) + points((src != "") & F.contains(src, q), 60)
        + points(F.contains(all_text, q), 40) + src_hits * 12 + hits * 8 + points((F.size(tokens) > 0) & (hits == F.size(tokens)), 24)
    )
    base = points(filled(translations[preferred_lang]).isNotNull(), 12) if preferred_lang else F.lit(0)
    base = base + points(dst != "", 12) + points(src_hits > 0, 10)
    return F.when(q == "", base).when(hits > 0, asked + base)


def search_memory(entries: DataFrame, query: str | None, filters: dict[str, str] | None = None, tables: Sequence[str] = (), source_lang: str | None = None, target_lang: str | None = None, preferred_lang: str | None = None, limit: int = 10, pos: str = "pos") -> DataFrame:
    """entries with score and rank order, at most `limit`, ties in entry order.

    entries: row_key, source_text, translations map<lang, text>, table, page, section, pos. filters compare a
    column's normalised text; source and target languages have to have a text.
    """
    df = entries.where(F.col("table").isin(*tables)) if tables else entries
    for name, value in (filters or {}).items():
        df = df.where(F.lower(collapsed(name)) == " ".join(value.lower().split()))
    for lang in filter(None, (source_lang, target_lang)):
        df = df.where(filled(F.col("translations")[lang]).isNotNull())
    score = memory_score(F.lit(query or ""), "row_key", "source_text", F.col("translations"), source_lang, target_lang, preferred_lang)
    return df.withColumn("score", score).where("score is not null").orderBy(F.desc("score"), pos).limit(max(limit, 1))


def index_score(primary: Column, titles: Column, whole: Column | str, token: Column, query: Column | str) -> Column:
    """The score of one query token against a manual: primary names count whole or by containment either way, titles
    whole, by containment, or by standing in the query; all fields together a little. Texts in search form."""
    clean = lambda a: F.filter(a, lambda v: v != "")
    add = lambda a, f: F.aggregate(F.transform(clean(a), f), F.lit(0), lambda s, x: s + x)
    p = add(primary, lambda v: F.when(v == token, 90).when(F.contains(v, token) | F.contains(token, v), 60).otherwise(0))
    t = add(titles, lambda v: F.when(v == token, 60).when(F.contains(v, token), 30).when((F.length(v) >= 4) & F.contains(as_col(query), v), 30).otherwise(0))
    return F.when(token == "", 0).otherwise(p + t + F.when(F.contains(as_col(whole), token), 10).otherwise(0))


def search_index(rows: DataFrame, query: str, primary: Sequence[str], titles: Sequence[str], facets: dict[str, Sequence[str]] | None = None, limit: int = 10, tie: Sequence[str] = ()) -> DataFrame:
    """Manuals (array or string columns `primary` and `titles`) by the sum of their tokens' scores, above zero.

    facets: array column to the values of which it has to hold one. Ties in the order of `tie`. A query of the single
    word overview, or without tokens, returns no rows.
    """
    words = [w for w in query.split() if w.lower() != "overview"]
    df = rows
    for name, values in (facets or {}).items():
        df = df.where(F.arrays_overlap(F.col(name), F.array(*map(F.lit, values))))
    if not words:
        return df.withColumn("score", F.lit(0)).where("false")
    as_array = lambda c: F.col(c) if df.schema[c].dataType.typeName() == "array" else F.array(F.col(c))
    raw = df.withColumn("__p", F.concat(*map(as_array, primary))).withColumn("__t", F.concat(*map(as_array, titles)))
    sep = "\u0001"  # one Arrow pass normalises all fields of a row
    marked = raw.withColumn("__n", F.transform(F.concat("__p", "__t"), lambda v: F.coalesce(v, F.lit("")))).withColumn("__k", F.size("__p"))
    normal = marked.withColumn("__f", F.split(search_form_parts(F.array_join("__n", sep)), sep)).withColumn("__all", F.array_join("__f", " "))
    p, t = F.slice("__f", F.lit(1), F.col("__k")), F.slice("__f", F.col("__k") + 1, F.greatest(F.size("__f") - F.col("__k"), F.lit(0)))
    lowered = [" ".join(w.lower().split()) for w in words]
    score = sum((index_score(p, t, "__all", F.lit(w), F.lit(" ".join(lowered))) for w in lowered), F.lit(0))
    found = normal.withColumn("score", score).where("score > 0").drop("__p", "__t", "__n", "__k", "__all", "__f")
    return found.orderBy(F.desc("score"), *tie).limit(max(limit, 1))
