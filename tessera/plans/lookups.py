"""Lookups and joins on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import collapsed, tokens
from tessera.functions.values import version_key
from tessera.operators import lookup
from tessera.plans.registry import Tables, query


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) = 1""")
def latest_per_key(t: Tables) -> DataFrame:
    df = t.orders.where("o_orderpriority <> '5-LOW'").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return lookup.best_per_key(df, ["o_custkey"], [F.col("o_orderdate"), F.col("o_totalprice")], "o_orderkey").drop("o_orderdate")


@query("""
WITH m AS (
  SELECT o_custkey, o_orderkey, o_totalprice, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_pos,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r
  FROM orders WHERE o_orderstatus = 'F' AND starts_with(o_orderpriority, '1'))
SELECT o_custkey, o_orderkey, o_totalprice, (SELECT count(*) FROM m WHERE r = 1) AS matched_count,
  least(10, (SELECT count(*) FROM m WHERE r = 1)) AS returned_count, (SELECT count(*) FROM m WHERE r = 1) > 10 AS truncated
FROM m WHERE r = 1 ORDER BY first_pos LIMIT 10""")
def latest_with_limit(t: Tables) -> DataFrame:
    """The queue query: filter, latest per key, the first ten in order of first appearance and how many there are."""
    from tessera.operators.predicates import matches_all

    df = t.orders.where(matches_all(equal={"o_orderstatus": "f"}, begins={"o_orderpriority": "1"})).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    best = lookup.best_per_key(df, ["o_custkey"], [F.col("o_orderdate")], "o_orderkey", "first_pos")
    return lookup.limited(best, ["first_pos"], 10).drop("o_orderdate", "first_pos")


@query("""
WITH v AS (SELECT p_partkey, p_brand, p_type, 'v' || (p_size % 12) || '.' || (p_partkey % 11) AS version, p_size % 5 = 0 AS ready FROM part)
SELECT p_brand AS latest_key, p_partkey AS pos, version FROM v
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY string_split(substr(version, 2), '.')::BIGINT[] DESC, ready DESC, p_type LIKE '%STANDARD%' DESC, p_partkey) = 1""")
def latest_documents(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.lit("").alias("document_key"), F.concat_ws("_", F.col("p_brand"), F.lit("m"), F.concat(F.lit("v"), F.col("p_size") % 12, F.lit("."), F.col("p_partkey") % 11)).alias("document_id"), F.col("p_partkey").cast("string").alias("record_id"),
        F.concat(F.lit("v"), F.col("p_size") % 12, F.lit("."), F.col("p_partkey") % 11).alias("version"), (F.col("p_size") % 5 == 0).alias("delivery_ready"), F.lit("").alias("delivery_url"),
        F.when(F.col("p_type").contains("STANDARD"), "Success").otherwise("").alias("result"), F.col("p_partkey").alias("pos"),
    )
    found = lookup.latest_documents(rows)
    return found.select(F.regexp_replace("latest_key", "_m$", "").alias("latest_key"), "pos", "version")


_RULES = [
    # (row_key, model, region, page, is_latest, value, line)
    ("BUILDING", "", "", "", "", "any", 2),
    ("BUILDING", "", "EUROPE", "", "yes", "in europe", 3),
    ("BUILDING", "NATION1, NATION2", "", "", "1", "named nations", 4),
    ("BUILDING", "", "ASIA;AFRICA", "", "no", "never", 5),
    ("MACHINERY", "", "AMERICA", "", "", "", 6),
    ("MACHINERY", "", "AMERICA", "", "", "second", 7),
    ("MACHINERY", "", "", "", "true", "fallback", 8),
    ("HOUSEHOLD", "NATION3", "ASIA", "", "true", "exact", 9),
    ("HOUSEHOLD", "NATION3", "", "", "true", "model", 10),
    ("FURNITURE", "", "", "", "false", "off", 11),
]
_RULES_SQL = ", ".join(str(r) for r in _RULES)


@query(f"""
WITH u(row_key, model, region, page, is_latest, value, line) AS (VALUES {_RULES_SQL}),
g AS (SELECT c_custkey AS target_id, c_mktsegment AS row_key, upper(n_name) AS m, upper(r_name) AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
h AS (
  SELECT target_id, line, value, is_latest,
    CASE WHEN model <> '' THEN 8 ELSE 0 END + CASE WHEN region <> '' THEN 8 ELSE 0 END + CASE WHEN value <> '' THEN 2 ELSE 0 END + CASE WHEN is_latest <> '' THEN 1 ELSE 0 END AS score
  FROM g JOIN u USING (row_key)
  WHERE lower(is_latest) IN ('', '1', 'true', 'yes', 'y')
    AND (model = '' OR list_contains(list_transform(regexp_split_to_array(model, '[,;]+'), lambda x: upper(trim(x))), m))
    AND (region = '' OR list_contains(list_transform(regexp_split_to_array(region, '[,;]+'), lambda x: upper(trim(x))), r)))
SELECT target_id, value, line::BIGINT AS line, score FROM h WHERE value <> '' QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY score DESC, line) = 1""")
def ranked_specificity_lookup(t: Tables) -> DataFrame:
    rules = t.rows(_RULES, "row_key string, model string, region string, page string, is_latest string, value string, line long")
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    targets = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("target_id"), F.col("c_mktsegment").alias("row_key"), F.upper("n_name").alias("model"), F.upper("r_name").alias("region"), F.array().cast("array<string>").alias("pages"))
    return lookup.spec_values(lookup.spec_matches(rules, targets)).select("target_id", "value", "line", "score")


@query("""
WITH k AS (SELECT md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS text_key, doc_id FROM documents)
SELECT text_key, CASE WHEN min(doc_id) = max(doc_id) THEN min(doc_id) END AS doc_id, CASE WHEN min(doc_id) = max(doc_id) THEN 'unique' ELSE 'ambiguous' END AS status
FROM k WHERE text_key IS NOT NULL GROUP BY text_key""")
def unique_or_abstain(t: Tables) -> DataFrame:
    keyed = t.documents.where("text is not null").select(F.md5(F.lower(collapsed("text"))).alias("text_key"), "doc_id")
    return lookup.unique_or_abstain(keyed, ["text_key"], "doc_id")


@query("""
WITH a AS (SELECT l_orderkey, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY l_orderkey),
b AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem JOIN a USING (l_orderkey) WHERE a.lo <> a.hi GROUP BY l_orderkey, l_linenumber)
SELECT l_orderkey, NULL::INTEGER AS l_linenumber, lo AS l_partkey, 'unique' AS status FROM a WHERE lo = hi
UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN lo = hi THEN lo END, CASE WHEN lo = hi THEN 'fallback' ELSE 'ambiguous' END FROM b""")
def fallback_disambiguation(t: Tables) -> DataFrame:
    return lookup.fallback_disambiguation(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber"], "l_partkey")


@query("""
SELECT norm, CASE WHEN n = 1 THEN p END AS p_partkey, CASE WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS status
FROM (SELECT p_name || ' ' || p_brand AS norm, count(*) AS n, min(p_partkey) AS p FROM part GROUP BY 1)""")
def value_index(t: Tables) -> DataFrame:
    return lookup.value_index(t.part.withColumn("v", F.concat_ws("  ", "p_name", "p_brand")), "v", ["p_partkey"])


@query("""
WITH l AS (
  SELECT doc_id, unnest(list_concat([text], string_split(text, chr(10)))) AS raw, unnest(range(len(string_split(text, chr(10))) + 1)) AS hit_at FROM documents),
n AS (SELECT doc_id, hit_at, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS norm FROM l),
i AS (
  SELECT norm, min(item_id) AS item_id FROM (
    SELECT item_id, trim(regexp_replace(unnest(string_split(text, chr(10))), '\\s+', ' ', 'g')) AS norm FROM benchmark) WHERE norm <> '' GROUP BY norm HAVING count(*) = 1)
SELECT doc_id, item_id, hit_at::BIGINT AS hit_at FROM n JOIN i USING (norm) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hit_at) = 1""")
def ordered_probe(t: Tables) -> DataFrame:
    index = lookup.value_index(t.benchmark.select("item_id", F.explode(F.split("text", "\n")).alias("v")), "v", ["item_id"])
    text = F.coalesce("text", F.lit(""))
    tries = F.transform(F.concat(F.array(text), F.split(text, "\n")), lambda v: F.trim(F.regexp_replace(v, r"\s+", " ")))
    return lookup.ordered_probe(t.documents, "doc_id", tries, index, ["item_id"]).select("doc_id", "item_id", F.col("hit_at").cast("long").alias("hit_at"))


@query("""
WITH m AS (
  SELECT norm, lang, min(text) AS lo, max(text) AS hi FROM (
    SELECT p_name AS norm, 'fr' AS lang, p_brand AS text FROM part
    UNION ALL SELECT p_name, 'de', p_type FROM part WHERE p_size < 2 AND p_partkey % 2 = 0) GROUP BY norm, lang)
SELECT p_partkey, l.lang, CASE WHEN l.lang = 'en' THEN p_name ELSE coalesce(m.lo, p_name) END AS localized, l.lang <> 'en' AND m.lo IS NULL AS missing
FROM part CROSS JOIN (VALUES ('en'), ('fr'), ('de')) l(lang) LEFT JOIN m ON m.norm = p_name AND m.lang = l.lang AND m.lo = m.hi""")
def coalesce_translation_join(t: Tables) -> DataFrame:
    memory = t.part.select(F.col("p_name").alias("en"), F.col("p_brand").alias("fr"), F.when(F.expr("p_size < 2 and p_partkey % 2 = 0"), F.col("p_type")).alias("de"))
    index = lookup.translation_index(memory, "en", ["fr", "de"])
    rows = t.part.select("p_partkey", "p_name", F.lit("en").alias("source_lang"))
    return lookup.translated(rows, "p_name", "source_lang", index, ["en", "fr", "de"]).select("p_partkey", "lang", "localized", "missing")


@query("""
SELECT norm, lang, CASE WHEN min(text) = max(text) THEN min(text) END AS text, min(text) <> max(text) AS conflict
FROM (SELECT p_name AS norm, 'brand' AS lang, p_brand AS text FROM part UNION ALL SELECT p_name, 'type', p_type FROM part) GROUP BY norm, lang""")
def translation_conflicts(t: Tables) -> DataFrame:
    return lookup.translation_index(t.part.select("p_name", F.col("p_brand").alias("brand"), F.col("p_type").alias("type")), "p_name", ["brand", "type"])


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) AND trim(b.text) <> ''")
def containment_match(t: Tables) -> DataFrame:
    needles = t.benchmark.select("item_id", F.col("text").alias("needle"))
    return lookup.containment(t.documents.select("doc_id", "text"), "text", needles, "item_id", "needle").select("doc_id", "item_id")


@query("""
WITH d(variable, model, value, is_default) AS (VALUES ('limit', 'BUILDING', '10', false), ('limit', 'MACHINERY', '20', false), ('limit', 'MACHINERY', '21', false), ('limit', '', '5', true)),
h AS (SELECT c_custkey, c_mktsegment, value, model = c_mktsegment AS exact, is_default, CASE WHEN c_nationkey % 2 = 0 THEN 'fr' ELSE 'en' END AS lang FROM customer CROSS JOIN d),
g AS (SELECT c_custkey, lang, count(*) FILTER (exact) AS ne, max(value) FILTER (exact) AS ve, count(*) FILTER (NOT exact AND is_default) AS nd, max(value) FILTER (NOT exact AND is_default) AS vd FROM h GROUP BY ALL)
SELECT c_custkey AS request_id, CASE WHEN (CASE WHEN ne > 0 THEN ne ELSE nd END) = 1 THEN CASE WHEN lang = 'fr' AND coalesce(ve, vd) = '10' THEN 'dix' ELSE coalesce(ve, vd) END END AS value,
  CASE WHEN ne > 1 THEN 'duplicate' ELSE 'found' END AS status FROM g""")
def variable_values(t: Tables) -> DataFrame:
    defaults = t.rows([("limit", ["building"], "10", False), ("limit", ["MACHINERY"], "20", False), ("limit", ["MACHINERY"], "21", False), ("limit", [], "5", True)], "variable string, models array<string>, value string, is_default boolean")
    overrides = t.rows([("limit", "fr", "10", "dix"), ("limit", "de", "5", "fünf")], "variable string, lang string, source_value string, value string")
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.lit("limit").alias("variable"), F.col("c_mktsegment").alias("model"), F.when(F.col("c_nationkey") % 2 == 0, "fr").otherwise("en").alias("lang"))
    return lookup.variable_values(defaults, asked, overrides).select("request_id", "value", "status")


@query("""
WITH c(copy_key, region, model, is_latest, version, text, line) AS (VALUES
  ('hello', '', '', '', '', 'hello all', 2), ('hello', 'ALL', 'BUILDING|MACHINERY', 'TRUE', '', 'hello makers', 3), ('hello', 'fr', 'BUILDING', 'TRUE', '1', 'bonjour', 4), ('hello', 'fr', '', 'FALSE', '', 'old', 5)),
q AS (SELECT c_custkey, c_mktsegment AS m, CASE WHEN c_nationkey % 3 = 0 THEN 'FR' ELSE 'US' END AS r FROM customer),
h AS (SELECT c_custkey, text, line, version <> '' AS v,
    CASE WHEN region = '' OR region = 'ALL' THEN 0 ELSE 2 END + CASE WHEN model = '' THEN 0 ELSE 2 END AS score
  FROM q CROSS JOIN c WHERE is_latest <> 'FALSE' AND (region IN ('', 'ALL') OR upper(region) = r) AND (model = '' OR list_contains(string_split(model, '|'), m)))
SELECT c_custkey AS request_id, text, line, 'found' AS status FROM h QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, v DESC, line) = 1""")
def localized_copy(t: Tables) -> DataFrame:
    rows = t.rows([("hello", "", "", "", "", "hello all", 2), ("hello", "ALL", "BUILDING|MACHINERY", "TRUE", "", "hello makers", 3), ("hello", "fr", "BUILDING", "TRUE", "1", "bonjour", 4), ("hello", "fr", "", "FALSE", "", "old", 5)], "copy_key string, region string, model string, is_latest string, version string, text string, line int")
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.lit("hello").alias("copy_key"), F.col("c_mktsegment").alias("model"), F.when(F.col("c_nationkey") % 3 == 0, "FR").otherwise("US").alias("region"))
    return lookup.copy_texts(rows, asked)


@query("""
WITH e(name, dim, file) AS (VALUES ('note', 'BUILDING', 'b2'), ('note', 'BUILDING', 'b1'), ('note', '', 'general'), ('other', 'MACHINERY', 'm'))
SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'b1' ELSE 'general' END
  WHEN c_mktsegment = 'MACHINERY' THEN 'm' END AS file FROM customer""")
def snippet_select(t: Tables) -> DataFrame:
    entries = t.rows([("note", "building", "b2"), ("note", "building", "b1"), ("note", "", "general"), ("other", "MACHINERY", "m")], "name string, region string, file string")
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.when(F.col("c_custkey") % 2 == 0, "note").otherwise("other").alias("name"), F.col("c_mktsegment").alias("region"))
    return lookup.best_or_default(entries, asked, "name", "region", "file")


@query("""
SELECT c_custkey AS request_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'b.png' WHEN 'MACHINERY' THEN NULL ELSE 'base.png' END AS asset,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'BUILDING' WHEN 'MACHINERY' THEN NULL ELSE 'ALL' END AS scope,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'ambiguous' ELSE 'found' END AS status FROM customer""")
def asset_override(t: Tables) -> DataFrame:
    assets = t.rows([("logo", "ALL", "base.png"), ("logo", "BUILDING", "b.png"), ("logo", "MACHINERY", "m1.png"), ("logo", "machinery,OTHER", "m2.png")], "asset_key string, scope string, asset string")
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.lit("logo").alias("asset_key"), F.col("c_mktsegment").alias("model"))
    return lookup.base_and_override(assets, asked)


@query("""
WITH s AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice > 250000 AS dear FROM orders),
c AS (SELECT c_custkey AS candidate_id, c_custkey AS o_custkey, 'F' AS st, '1-URGENT' AS pr, true AS dear FROM customer),
a AS (SELECT candidate_id, o_orderkey, o_orderpriority = pr AS hit_p, o_orderstatus = st AS hit_s, s.dear = c.dear AS same, count(*) OVER (PARTITION BY candidate_id) AS n,
  count(*) FILTER (o_orderstatus = st) OVER (PARTITION BY candidate_id) AS hits FROM c JOIN s USING (o_custkey)),
b AS (SELECT *, count(*) OVER (PARTITION BY candidate_id) AS n2, count(*) FILTER (hit_p) OVER (PARTITION BY candidate_id) AS hits2 FROM a WHERE n = 1 OR hits = 0 OR hit_s),
d AS (SELECT candidate_id, count(*) AS n, min(o_orderkey) AS k, bool_and(same) AS same FROM b WHERE n2 = 1 OR hits2 = 0 OR hit_p GROUP BY candidate_id)
SELECT candidate_id, CASE WHEN n IS NULL THEN 'create' WHEN n > 1 THEN 'review' WHEN same THEN 'noop' ELSE 'update' END AS action,
  CASE WHEN n = 1 THEN k END AS o_orderkey, CASE WHEN n = 1 THEN CASE WHEN same THEN '' ELSE 'dear' END END AS changed
FROM c LEFT JOIN d USING (candidate_id)""")
def candidate_actions(t: Tables) -> DataFrame:
    snapshot = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") > 250000).alias("dear"))
    candidates = t.customer.select(F.col("c_custkey").alias("candidate_id"), F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit(True).alias("dear"))
    return lookup.candidate_actions(candidates, snapshot, ["o_custkey"], ["o_orderstatus", "o_orderpriority"], ["dear"], "o_orderkey")


@query("""
WITH o AS (SELECT p_name AS label, CAST(p_size % 3 AS VARCHAR) AS line_order, p_brand AS row_key FROM part),
e AS (SELECT p_name AS label, CAST(p_size % 3 AS VARCHAR) AS line_order, 'K' || (p_partkey % 7) AS row_key FROM part WHERE p_size = 1),
p AS (SELECT label, line_order FROM o UNION SELECT label, line_order FROM e)
SELECT p.label, p.line_order, coalesce(
  (SELECT min(row_key) FROM e WHERE e.label = p.label AND e.line_order = p.line_order), (SELECT min(row_key) FROM e WHERE e.label = p.label),
  (SELECT min(row_key) FROM o WHERE o.label = p.label AND o.line_order = p.line_order AND row_key <> 'Brand#1'), '') AS row_key FROM p""")
def label_keys(t: Tables) -> DataFrame:
    label = [F.col("p_name").alias("label"), (F.col("p_size") % 3).cast("string").alias("line_order")]
    observed = t.part.select(*label, F.col("p_brand").alias("row_key"))
    existing = t.part.where("p_size = 1").select(*label, F.concat(F.lit("K"), F.col("p_partkey") % 7).alias("row_key"))
    return lookup.label_keys(observed, existing, t.part.where("p_brand <> 'Brand#1'").select(F.col("p_brand").alias("row_key")))


@query("""
SELECT p_brand, p_partkey, 'v' || (p_size % 10) || '.' || (p_partkey % 12) AS version,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 10 DESC, p_partkey % 12 DESC, p_partkey) AS rank FROM part""")
def version_sort(t: Tables) -> DataFrame:
    version = F.concat(F.lit("v"), F.col("p_size") % 10, F.lit("."), F.col("p_partkey") % 12)
    df = t.part.select("p_brand", "p_partkey", version.alias("version"))
    return lookup.ranked(df, ["p_brand"], [F.desc(version_key("version")), F.col("p_partkey")])


@query("""
SELECT token, count(*) AS n FROM (SELECT unnest(list_distinct(list_filter(list_transform(regexp_split_to_array(p_name || ',' || p_type || ';;' || p_brand, '[,;]+'), lambda x: trim(x)), lambda x: x <> ''))) AS token FROM part) GROUP BY token""")
def multi_value_tokens(t: Tables) -> DataFrame:
    cell = F.concat(F.col("p_name"), F.lit(","), F.col("p_type"), F.lit(";;"), F.col("p_brand"))
    return t.part.select(F.explode(tokens(cell)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query("""
SELECT l.lang, p_brand AS slot, 0 AS part, p_brand AS item FROM (SELECT DISTINCT p_brand FROM part) CROSS JOIN (VALUES ('en'), ('fr')) l(lang)
UNION ALL SELECT 'fr', p_brand, 1, p_name FROM (SELECT DISTINCT p_brand, p_name FROM part WHERE p_size = 1)""")
def skeleton_slots(t: Tables) -> DataFrame:
    slots = t.part.groupBy(F.col("p_brand").alias("slot")).agg(F.min("p_partkey").alias("slot_order"))
    mounted = t.part.where("p_size = 1").select(F.col("p_brand").alias("anchor"), F.lit("fr").alias("lang"), F.col("p_name").alias("item")).distinct()
    return lookup.skeleton(slots, ["en", "fr"], mounted).select("lang", "slot", "part", "item")


@query("""
SELECT p_brand AS footnote_id, p_partkey AS line, 'exact' AS how FROM part WHERE p_size = 7
UNION ALL
SELECT p_brand, line, 'fallback' FROM (
  SELECT p_brand, p_partkey AS line, p_type <> 'ECONOMY' AS named FROM part WHERE p_size = 9 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 7)
  QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY named, CAST(p_partkey AS VARCHAR)) = 1)""")
def footnote_fallback(t: Tables) -> DataFrame:
    """Size 7 stands for rows of the target's region, size 9 for rows of another one."""
    notes = t.part.where("p_size in (7, 9)").select(
        F.col("p_brand").alias("footnote_id"), F.lit("specs").alias("page"), F.when(F.col("p_size") == 7, "EU").otherwise("US").alias("region"),
        F.when(F.col("p_type") == "ECONOMY", "").otherwise("M1").alias("model"), F.lit("en").alias("source_lang"), F.col("p_partkey").cast("string").alias("line"), F.lit("").alias("is_latest"),
    )
    refs = t.part.select(F.lit("specs").alias("page"), F.col("p_brand").alias("footnote_id"))
    return lookup.footnotes(notes, refs, "M1", "EU").select("footnote_id", F.col("line").cast("long").alias("line"), "how")


@query("""
WITH b AS (
  SELECT CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_brand || '_' || (p_size % 3 + 1) END AS ph, p_name AS v FROM part
  QUALIFY row_number() OVER (PARTITION BY p_brand, p_size % 3 ORDER BY p_size DESC, p_partkey) = 1)
SELECT ph AS placeholder, v AS value FROM b UNION ALL SELECT ph || '_BOLD', '**' || v || '**' FROM b UNION ALL SELECT ph || '_LOWER', lower(v) FROM b""")
def substitution_map(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_brand").alias("placeholder"), F.concat((F.col("p_size") % 3 + 1).cast("string"), F.lit(".0")).alias("line_order"), F.col("p_name").alias("value"), F.col("p_size").alias("score"), F.col("p_partkey").alias("line"))
    return lookup.substitutions(rows)
