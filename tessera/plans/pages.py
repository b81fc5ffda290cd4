"""Pages, contracts, assets, review branches and queue rows on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import pages
from tessera.plans.registry import Tables, query


@query("""
SELECT p_name AS label, NULL AS text, 'row' AS origin FROM part UNION ALL SELECT NULL, s_name, 'footnote' FROM supplier UNION ALL SELECT NULL, n_name, 'note' FROM nation""")
def rows_with_notes(t: Tables) -> DataFrame:
    return pages.with_notes(t.part.select(F.col("p_name").alias("label")), t.supplier.select(F.col("s_name").alias("text")), t.nation.select(F.col("n_name").alias("text"))).select("label", "text", "origin")


@query("SELECT p_partkey, 'symbols' AS page_id FROM part")
def blocks_of_page(t: Tables) -> DataFrame:
    return pages.page_blocks(t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "symbols").otherwise(" ").alias("page_id")), "symbols")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS record_id, p_name AS document, lower(p_brand) AS family, CASE p_size % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN p_type ELSE '' END AS trigger FROM part""")
def typed_queue_rows(t: Tables) -> DataFrame:
    text = lambda c: F.to_json(F.array(F.struct(F.col(c).alias("text"))))
    n = F.col("p_size") % 3
    fields = F.create_map(F.lit("Doc"), text("p_name"), F.lit("Family"), F.concat(F.lit('"'), "p_brand", F.lit('"')), F.lit("Trigger"), F.when(n == 0, "true").otherwise("null"), F.lit("Old trigger"), F.when(n == 2, '[{"text": " "}]').otherwise(text("p_type")))
    return pages.queue_rows(t.part.select(F.col("p_partkey").cast("string").alias("record_id"), fields.alias("fields")), {"document": ["Doc"], "family": ["Family"], "trigger": ["Trigger", "Old trigger"]}, ["family"])


@query("""
WITH p AS (SELECT DISTINCT p_brand AS target, CASE WHEN p_size % 2 = 0 THEN 'fr' ELSE 'en' END AS lang, p_type AS page FROM part),
c AS (SELECT DISTINCT p_type AS page, CASE WHEN p_size % 2 = 0 THEN 'asset' ELSE 'copy' END AS kind, 'n' || (p_size % 5) AS name, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'FR' ELSE 'en' END AS lang FROM part),
h AS (SELECT p_brand AS target, CASE WHEN p_size % 4 < 2 THEN 'asset' ELSE 'copy' END AS kind, 'n' || (p_size % 5) AS name, CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN 'fr' ELSE 'en' END AS lang FROM part WHERE p_size < 12)
SELECT target AS ref, page AS field, lang, kind, name FROM (SELECT DISTINCT p.target, p.lang, p.page, c.kind, c.name, c.lang AS asked FROM p JOIN c USING (page) WHERE c.lang = '' OR lower(c.lang) = p.lang) w
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.target = w.target AND h.kind = w.kind AND h.name = w.name AND h.lang IN ('', w.lang))""")
def page_contracts(t: Tables) -> DataFrame:
    n, p = F.col("p_size"), t.part
    name = F.concat(F.lit("n"), n % 5).alias("name")
    asked = p.select(F.col("p_type").alias("page"), F.when(n % 2 == 0, "asset").otherwise("copy").alias("kind"), name, F.when(n % 3 == 0, " ").when(n % 3 == 1, "FR").otherwise("en").alias("lang"))
    have = p.where("p_size < 12").select(F.col("p_brand").alias("target"), F.when(n % 4 < 2, "asset").otherwise("copy").alias("kind"), name, F.when(n % 7 == 0, "").when(n % 7 == 1, "fr").otherwise("EN").alias("lang"))
    found = pages.contract_issues(p.select(F.col("p_brand").alias("target"), F.when(n % 2 == 0, "fr").otherwise("en").alias("lang"), F.col("p_type").alias("page")), asked, have)
    return found.select("ref", "field", "lang", F.get_json_object("evidence", "$.kind").alias("kind"), F.get_json_object("evidence", "$.name").alias("name"))


@query("""
SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN 'specifications' ELSE p_brand END AS page, unnest(['f' || (p_size % 6), p_type]) AS id FROM part WHERE p_size % 3 <> 0""")
def ids_by_page(t: Tables) -> DataFrame:
    n = F.col("p_size")
    rows = t.part.select(F.when(n % 4 == 0, "").otherwise(F.col("p_brand")).alias("page"), F.when(n % 3 != 0, F.concat(F.lit("f"), n % 6, F.lit(", "), "p_type", F.lit(","))).alias("refs"))
    return pages.ids_by_page(rows, "page", "refs")


@query("""
SELECT 'a' || p_partkey AS path, CASE WHEN p_size % 5 = 0 THEN 'unregistered' WHEN p_size % 5 = 1 THEN 'missing' WHEN p_size % 5 = 2 THEN 'duplicate' ELSE 'changed' END AS code FROM part WHERE p_size % 5 < 4""")
def asset_registry(t: Tables) -> DataFrame:
    n = F.col("p_size") % 5
    path = F.concat(F.lit("a"), "p_partkey").alias("path")
    registry = t.part.where(n != 0).select(path, F.sha2("p_name", 256).alias("sha256"), F.explode(F.sequence(F.lit(1), F.when(n == 2, 2).otherwise(1)))).drop("col")
    return pages.registry_issues(registry, t.part.where(n != 1).select(path, F.sha2(F.when(n == 3, F.col("p_brand")).otherwise(F.col("p_name")), 256).alias("sha256")))


@query("""
WITH b AS (SELECT CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 't' || (s_suppkey % 40) END AS token, s_nationkey AS m, s_suppkey % 3 AS r, 'ref' || (s_suppkey % 50) AS git_ref FROM supplier),
k AS (SELECT token, min(git_ref) AS lo, max(git_ref) AS hi FROM b WHERE token IS NOT NULL GROUP BY 1), n AS (SELECT m, r, min(git_ref) AS lo, max(git_ref) AS hi FROM b GROUP BY ALL),
a AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 't' || (c_custkey % 60) END AS token, c_nationkey AS m, c_custkey % 3 AS r FROM customer),
x AS (SELECT c_custkey, coalesce(k.lo, n.lo) AS lo, CASE WHEN k.lo IS NOT NULL THEN k.hi ELSE n.hi END AS hi FROM a LEFT JOIN k USING (token) LEFT JOIN n USING (m, r))
SELECT c_custkey AS request_id, CASE WHEN lo = hi THEN lo END AS git_ref, CASE WHEN lo IS NULL THEN 'missing' WHEN lo <> hi THEN 'ambiguous' ELSE 'found' END AS status FROM x""")
def review_branches(t: Tables) -> DataFrame:
    told = lambda c, form: F.concat(F.lit(form), F.col(c))
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    branches = t.supplier.select(F.when(s % 4 == 0, " ").otherwise(F.concat(F.lit("t"), s % 40)).alias("token"), told("s_nationkey", "M-").alias("model"), F.concat(F.lit("R "), s % 3).alias("region"), F.concat(F.lit("ref"), s % 50).alias("git_ref"))
    asked = t.customer.select(c.alias("request_id"), F.when(c % 2 == 0, F.concat(F.lit("t"), c % 60)).alias("token"), told("c_nationkey", "m").alias("model"), F.concat(F.lit("r"), c % 3).alias("region"))
    return pages.review_branches(asked, branches)
