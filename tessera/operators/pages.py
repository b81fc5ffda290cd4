"""Pages and what they need: blocks with their notes, contracts, references, assets, review branches, queue rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import filled, tokens
from tessera.functions.variants import choice_text
from tessera.operators.lookup import small, strict
from tessera.operators.quality import finding


def with_notes(rows: DataFrame, footnotes: DataFrame | None = None, notes: DataFrame | None = None) -> DataFrame:
    """rows and the rows of their optional footnote and note tables, with `origin`; columns that one lacks are null."""
    out = rows.withColumn("origin", F.lit("row"))
    for df, origin in ((footnotes, "footnote"), (notes, "note")):
        if df is not None:
            out = out.unionByName(df.withColumn("origin", F.lit(origin)), allowMissingColumns=True)
    return out


def page_blocks(rows: DataFrame, page: str, column: str = "page_id") -> DataFrame:
    """The rows of a page's block table: a blank page is filled in; running it fails on a row of another page."""
    if column not in rows.columns:
        return rows.withColumn(column, F.lit(page))
    own = rows.withColumn(column, F.coalesce(filled(column), F.lit(page)))
    return strict(own, F.col(column) != page, f"a row of the table of page {page} names another page")


def queue_rows(records: DataFrame, names: dict[str, Sequence[str]], lowered: Sequence[str] = ()) -> DataFrame:
    """Raw records (record_id, fields map<string, JSON text>) as typed rows: each column of `names` is the text of the first
    of its field names that is filled, or empty. A record without an id fails."""

    def one(column: str, fields: Sequence[str]) -> Column:
        text = F.coalesce(*[filled(choice_text(F.col("fields")[f])) for f in fields], F.lit(""))
        return (F.lower(text) if column in lowered else text).alias(column)

    known = strict(records, filled("record_id").isNull(), "a queue record has no record_id")
    return known.select("record_id", *[one(c, fields) for c, fields in names.items()])


def contract_issues(pages: DataFrame, contracts: DataFrame, provided: DataFrame) -> DataFrame:
    """A finding for everything that a target's page has to have and the target does not provide.

    pages: target, lang, page; contracts: page, kind (placeholder, copy, value or asset), name, lang; provided: target,
    kind, name, lang. A blank lang of a contract asks for every language, a blank one of a provision serves every one.
    """
    told = contracts.select("page", "kind", "name", filled("lang").alias("__only")).distinct()
    want = pages.select("target", "lang", "page").distinct().join(small(told), "page").where(F.col("__only").isNull() | (F.lower("__only") == F.lower("lang")))
    have = provided.select("target", "kind", "name", F.lower(filled("lang")).alias("__lang"))
    on = ["target", "kind", "name"]
    lacking = want.join(have.where("__lang is null").select(*on), on, "left_anti").withColumn("__lang", F.lower("lang"))
    lacking = lacking.join(have.where("__lang is not null"), [*on, "__lang"], "left_anti")
    return finding(lacking, "page_contract", "FAIL", "target", F.concat(F.lit("missing "), F.col("kind")), "page", "lang", {"kind": F.col("kind"), "name": F.col("name")})


def ids_by_page(rows: DataFrame, page: str, refs: str, default: str = "specifications") -> DataFrame:
    """(page, id): the distinct ids that the rows of a page refer to; rows without a page are of the default one."""
    return rows.select(F.coalesce(filled(page), F.lit(default)).alias("page"), F.explode(tokens(refs, ",")).alias("id")).distinct()


def registry_issues(registry: DataFrame, found: DataFrame) -> DataFrame:
    """(path, code) of an asset registry against the files that are there, both (path, sha256): duplicate, missing,
    changed or unregistered."""
    one = registry.groupBy("path").agg(F.count("*").alias("n"), F.max("sha256").alias("r"))
    both = one.join(found.select("path", F.col("sha256").alias("f")), "path", "full")
    code = F.when(F.col("n").isNull(), "unregistered").when(F.col("f").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(~F.col("r").eqNullSafe(F.col("f")), "changed")
    return both.select("path", code.alias("code")).where("code is not null")


def review_branches(requests: DataFrame, branches: DataFrame) -> DataFrame:
    """(request_id, git_ref, status): the review branch of an edited document: by its token, without one by model and region
    (letters and digits alone count). Several branches are ambiguous, never a guess.

    requests: request_id, token, model, region; branches: token, model, region, git_ref.
    """
    bare = lambda c: F.lower(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[^\p{L}\p{N}]", ""))
    known = branches.where(filled("git_ref").isNotNull()).select(filled("token").alias("token"), bare("model").alias("m"), bare("region").alias("r"), "git_ref")
    of = lambda keys, side: known.groupBy(*keys).agg(F.min("git_ref").alias(f"{side}_lo"), F.max("git_ref").alias(f"{side}_hi"))
    asked = requests.select("request_id", filled("token").alias("token"), bare("model").alias("m"), bare("region").alias("r"))
    both = asked.join(of(["token"], "t").where("token is not null"), "token", "left").join(of(["m", "r"], "n").where("m <> '' and r <> ''"), ["m", "r"], "left")
    lo, hi = F.coalesce("t_lo", "n_lo"), F.when(F.col("t_lo").isNotNull(), F.col("t_hi")).otherwise(F.col("n_hi"))
    status = F.when(lo.isNull(), "missing").when(lo != hi, "ambiguous").otherwise("found")
    return both.select("request_id", F.when(lo == hi, lo).alias("git_ref"), status.alias("status"))
