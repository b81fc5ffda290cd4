"""Records by kind, staging, cross-checks, unions and audits on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text, values
from tessera.operators import records
from tessera.plans.registry import Tables, query


@query("""
WITH i AS (SELECT 'parts' AS tb, p_name AS key, p_partkey AS id FROM part UNION ALL SELECT 'brands', p_brand, min(p_partkey) FROM part GROUP BY p_brand),
u AS (SELECT tb, key, min(id) AS lo, max(id) AS hi FROM i GROUP BY ALL),
r AS (SELECT o_orderkey AS request_id, CASE o_orderkey % 3 WHEN 0 THEN 'parts' WHEN 1 THEN 'brands' END AS tb, CASE o_orderkey % 3 WHEN 0 THEN p_name ELSE p_brand END AS key FROM orders JOIN part ON p_partkey = o_orderkey % 1999 + 1)
SELECT request_id, CASE WHEN lo = hi THEN lo END AS record_id, CASE WHEN r.tb IS NULL THEN 'unknown_kind' WHEN lo IS NULL THEN 'missing' WHEN lo <> hi THEN 'ambiguous' ELSE 'found' END AS status
FROM r LEFT JOIN u ON u.tb = r.tb AND u.key = r.key""")
def resolve_by_kind(t: Tables) -> DataFrame:
    part = t.part.select("p_partkey", "p_name", "p_brand")
    index = part.select(F.lit("parts").alias("table"), F.col("p_name").alias("key"), F.col("p_partkey").alias("record_id")).unionByName(part.groupBy(F.lit("brands").alias("table"), F.col("p_brand").alias("key")).agg(F.min("p_partkey").alias("record_id")))
    n = F.col("o_orderkey") % 3
    asked = t.orders.select("o_orderkey", (F.col("o_orderkey") % 1999 + 1).alias("p_partkey")).join(part, "p_partkey")
    requests = asked.select(F.col("o_orderkey").alias("request_id"), F.when(n == 0, "name").when(n == 1, "label").otherwise("other").alias("kind"), F.when(n == 0, F.col("p_name")).otherwise(F.col("p_brand")).alias("key"))
    return records.resolved_by_kind(requests, index, {"name": "parts", "label": "old_brands"}, {"old_brands": "brands"})


@query("SELECT DISTINCT o_orderkey AS request_id, o_orderkey * 10 + l_linenumber AS record_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'")
def records_of_row(t: Tables) -> DataFrame:
    index = t.lineitem.select(F.concat_ws("|", F.lit("o"), "l_orderkey", "l_linenumber").alias("key"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"))
    return records.records_of_row(t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("request_id"), F.concat_ws("|", F.lit("o"), "o_orderkey").alias("key")), index)


@query("""
WITH g AS (SELECT n_name AS variable, min('g' || n_nationkey) AS v FROM nation WHERE n_nationkey % 3 = 0 GROUP BY 1), h AS (SELECT n_name AS variable, 't' || n_nationkey AS v FROM nation WHERE n_nationkey % 2 = 0)
SELECT c_custkey AS row_id, n_name AS variable, coalesce(g.v, h.v) AS value, CASE WHEN g.v IS NOT NULL THEN 'given' WHEN h.v IS NOT NULL THEN 'table' ELSE 'none' END AS origin
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN g ON g.variable = n_name LEFT JOIN h ON h.variable = n_name""")
def row_variables(t: Tables) -> DataFrame:
    nation = t.nation
    asked = t.customer.join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("row_id"), F.col("n_name").alias("variable"))  # 25 nations
    given = nation.where("n_nationkey % 3 = 0").select(F.lower("n_name").alias("variable"), F.concat(F.lit("g"), "n_nationkey").alias("value"))
    return records.row_variables(asked, given, nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("variable"), F.concat(F.lit("t"), "n_nationkey").alias("value")))


@query("""
SELECT p_partkey AS key, CASE WHEN p_size = 1 THEN 'o' WHEN p_size % 3 = 0 THEN 'c' || p_brand WHEN p_size % 2 = 0 THEN p_name WHEN p_size < 30 THEN p_type END AS value,
  CASE WHEN p_size = 1 THEN 'override' WHEN p_size % 3 = 0 THEN 'candidate' WHEN p_size % 2 = 0 THEN 'current' WHEN p_size < 30 THEN 'sibling' ELSE 'none' END AS origin FROM part""")
def staged_values(t: Tables) -> DataFrame:
    key, p = F.col("p_partkey").alias("key"), t.part
    current = p.select(key, F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("").alias("value"))
    return records.staged(current, p.where("p_size < 30").select(key, F.col("p_type").alias("value")), p.where("p_size % 3 = 0").select(key, F.concat(F.lit("c"), "p_brand").alias("value")), p.where("p_size = 1").select(key, F.lit("o").alias("value")))


@query("""
WITH e AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), p AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linestatus = 'O'), a AS (SELECT p_partkey AS k FROM part WHERE p_size > 5)
SELECT CAST(k AS VARCHAR) AS l_partkey, 'not_printed' AS issue FROM e WHERE k NOT IN (SELECT k FROM p) UNION ALL SELECT CAST(k AS VARCHAR), 'not_expected' FROM p WHERE k NOT IN (SELECT k FROM e) UNION ALL SELECT CAST(k AS VARCHAR), 'no_asset' FROM p WHERE k NOT IN (SELECT k FROM a)""")
def asset_crosscheck(t: Tables) -> DataFrame:
    key = F.col("l_partkey").cast("string").alias("l_partkey")
    return records.asset_crosscheck(t.lineitem.where("l_returnflag = 'R'").select(key), t.lineitem.where("l_linestatus = 'O'").select(key), t.part.where("p_size > 5").select(F.col("p_partkey").cast("string").alias("l_partkey")), "l_partkey")


@query("""
SELECT 'orders' AS queue_scope, CAST(o_orderkey AS VARCHAR) AS record_id, o_orderstatus AS status, NULL AS name FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'customers', CAST(c_custkey AS VARCHAR), NULL, c_name FROM customer""")
def queue_union(t: Tables) -> DataFrame:
    orders = t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status"))
    return records.one_queue({"orders": orders, "customers": t.customer.select(F.col("c_custkey").alias("record_id"), F.col("c_name").alias("name"))}, ["record_id", "status", "name"])


@query("""
SELECT 'supplier' AS source, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_name, c_acctbal, c_mktsegment FROM customer""")
def concatenated_sources(t: Tables) -> DataFrame:
    return records.concatenated({"supplier": t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))})


@query("""
SELECT c_custkey AS request_id, CASE WHEN c_nationkey % 4 = 0 THEN 'ACHTUNG' WHEN c_nationkey % 4 = 1 THEN 'ATTENTION' WHEN c_nationkey % 4 = 2 THEN 'CAUTION' END AS label FROM customer""")
def signal_words(t: Tables) -> DataFrame:
    entries = t.rows([("caution", "de", "ACHTUNG"), ("caution", "fr", "ATTENTION"), ("caution", "en", "CAUTION"), ("caution", "es", " ")], "word string, lang string, label string")
    n = F.col("c_nationkey") % 4
    return records.signal_words(t.customer.select(F.col("c_custkey").alias("request_id"), F.when(n == 3, "notice").otherwise("Caution ").alias("word"), F.when(n == 0, "de-AT").when(n == 1, "FR").otherwise("es").alias("lang")), entries)


@query("""
SELECT face, metric, name, value::DOUBLE AS value FROM (
  SELECT 'orders' AS face, 'volume' AS metric, 'keys' AS name, count(DISTINCT o_custkey) AS value FROM orders UNION ALL SELECT 'orders', 'volume', 'total', sum(o_orderkey) FROM orders
  UNION ALL SELECT 'corpus', 'parts', 'rows', count(*) FROM part UNION ALL SELECT 'corpus', 'parts', 'largest_tier', round(max(n) / sum(n), 4) FROM (SELECT p_size % 4 AS k, count(*) AS n FROM part GROUP BY 1)
  UNION ALL SELECT 'corpus', 'parts', 'pass_rate', round(count(*) FILTER (p_size > 10) / count(*), 4) FROM part UNION ALL SELECT 'corpus', 'parts', 'files', count(DISTINCT p_partkey) FROM part
  UNION ALL SELECT 'corpus', 'parts', 'contents', count(DISTINCT p_name) FROM part UNION ALL SELECT 'corpus', 'parts', 'targets', count(DISTINCT (p_brand, p_type)) FROM part)""")
def dashboard(t: Tables) -> DataFrame:
    volume = records.distinct_and_sum(t.orders.select(F.col("o_custkey").cast("string").alias("c"), "o_orderkey"), "c", "o_orderkey")
    stats = records.corpus_statistics(t.part.withColumn("tier", F.col("p_size") % 4), "p_partkey", "p_name", F.concat_ws("/", "p_brand", "p_type"), "tier", F.col("p_size") > 10)
    return records.dashboard({"orders": {"volume": volume}, "corpus": {"parts": stats}})


@query("""
SELECT p_brand, count(*) AS n, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS types, array_to_string(list_sort(list(DISTINCT CAST(p_size % 7 AS VARCHAR))), ',') AS sizes, p_brand <> 'Brand#1' AS registered FROM part GROUP BY p_brand""")
def template_usage(t: Tables) -> DataFrame:
    used = records.template_usage(t.part.select("p_brand", "p_type", (F.col("p_size") % 7).cast("string").alias("size")), "p_brand", ["p_type", "size"], t.part.where("p_brand <> 'Brand#1'"))
    return used.select("p_brand", "n", F.array_join("p_type", ",").alias("types"), F.array_join("size", ",").alias("sizes"), "registered")


@query("SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS aliases FROM part WHERE p_size < 10 GROUP BY p_brand")
def alias_lists(t: Tables) -> DataFrame:
    return records.alias_lists(t.part.where("p_size < 10"), "p_brand", "p_type").select("p_brand", F.array_join("aliases", ",").alias("aliases"))


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_name END ELSE p_name END AS localized,
  CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_brand = 'Brand#1' THEN p_brand WHEN p_size % 4 = 1 THEN p_name ELSE p_brand END AS page_text, p_size % 5 = 0 AND p_partkey % 2 = 0 AS title,
  CASE p_size % 3 WHEN 0 THEN '' ELSE 'b' END AS fields FROM part""")
def value_picks(t: Tables) -> DataFrame:
    n = F.col("p_size")
    p = t.part.withColumn("fr", F.when(n % 2 == 0, F.col("p_type")).otherwise(" ")).withColumn("lang", F.when(n % 3 == 0, "en").when(n % 3 == 1, "FR").otherwise("de"))
    kept = records.filled_fields(F.create_map(F.lit("a"), F.lit(" "), F.lit("b"), F.when(n % 3 != 0, "x")))
    return p.select(
        "p_partkey", records.localized_value("p_name", F.col("lang"), F.lit("en"), {"fr": "fr"}).alias("localized"),
        records.page_value(F.when(n % 4 == 1, F.col("p_name")), F.col("p_brand"), F.when(n % 4 == 0, "Note").otherwise("row"), ["brand#1"]).alias("page_text"),
        records.is_title(F.when(n % 5 == 0, "spec.title").otherwise("spec.titles"), F.lit("Title"), F.when(F.col("p_partkey") % 2 == 0, "yes").otherwise("no")).alias("title"), F.array_join(F.map_keys(kept), ",").alias("fields"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_brand = 'Brand#1' THEN 'one' WHEN p_brand = 'Brand#1' THEN 'any' WHEN p_size % 3 = 1 AND p_brand = 'Brand#2' THEN 'two' END AS placeholder FROM part""")
def bound_placeholders(t: Tables) -> DataFrame:
    names = t.rows([("Brand#1", "0", "one"), ("Brand#1", "", "any"), ("Brand#2", "1", "two")], "row_key string, slot string, placeholder string")
    return records.bound_placeholders(t.part.select("p_partkey", F.col("p_brand").alias("row_key"), (F.col("p_size") % 3).cast("string").alias("slot")), names).select("p_partkey", "placeholder")


@query("""
WITH f AS (SELECT p_brand AS scope, CASE WHEN p_size % 9 = 0 THEN '' ELSE 'f' || (p_size % 6) END AS id, CASE WHEN p_size % 8 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS ord,
  CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN 'xx' ELSE 'en' END AS lang, CASE WHEN p_size % 10 = 0 THEN '* ' ELSE '' END || p_name AS text FROM part),
r AS (SELECT DISTINCT p_brand AS scope, 'f' || (p_size % 5 + 3) AS id FROM part WHERE p_size < 20)
SELECT scope, id AS footnote_id, 'missing_footnote_id' AS code FROM f WHERE id = '' UNION ALL SELECT scope, id, 'missing_footnote_order' FROM f WHERE ord = '' UNION ALL SELECT scope, id, 'missing_footnote_source_lang' FROM f WHERE lang = ''
UNION ALL SELECT scope, id, 'invalid_footnote_source_lang' FROM f WHERE lang IN ('xx', '') UNION ALL SELECT scope, id, 'footnote_text_contains_marker' FROM f WHERE starts_with(text, '*')
UNION ALL SELECT scope, id, 'duplicate_footnote_id' FROM f WHERE id <> '' GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT scope, min(id), 'duplicate_footnote_order' FROM f WHERE id <> '' AND ord <> '' GROUP BY scope, ord HAVING min(id) <> max(id)
UNION ALL SELECT scope, id, 'unknown_footnote_ref' FROM r WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.scope = r.scope AND f.id = r.id) UNION ALL SELECT DISTINCT scope, id, 'unused_footnote' FROM f WHERE id <> '' AND NOT EXISTS (SELECT 1 FROM r WHERE f.scope = r.scope AND f.id = r.id)""")
def footnote_issues(t: Tables) -> DataFrame:
    n = F.col("p_size")
    notes = t.part.select(
        F.col("p_brand").alias("scope"), F.when(n % 9 == 0, "").otherwise(F.concat(F.lit("f"), n % 6)).alias("footnote_id"), F.when(n % 8 == 0, "").otherwise(n.cast("string")).alias("ord"),
        F.when(n % 7 == 0, "").when(n % 7 == 1, "xx").otherwise("en").alias("lang"), F.concat(F.when(n % 10 == 0, "* ").otherwise(""), "p_name").alias("text"),
    )
    return records.footnote_issues(notes, t.part.where("p_size < 20").select(F.col("p_brand").alias("scope"), F.concat(F.lit("f"), n % 5 + 3).alias("footnote_id")))


@query("""
WITH r AS (SELECT p_brand AS scope, 'k' || (p_size % 30) AS k, CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_partkey % 3 AS VARCHAR) END AS s, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS v FROM part WHERE p_partkey <= 400),
w AS (SELECT unnest(['k1', 'k7', 'k14', 'kx']) AS k), g AS (SELECT scope, k, count(*) AS n, count(*) FILTER (v IS NULL) AS b FROM r GROUP BY ALL), z AS (SELECT scope, k, s, count(*) AS n, min(v) AS lo, max(v) AS hi FROM r GROUP BY ALL)
SELECT DISTINCT scope, k AS row_key, 'duplicate_latest_spec_row' AS code FROM z WHERE n > 1 UNION ALL SELECT scope, k, 'empty_required_spec_value' FROM g JOIN w USING (k) WHERE b = n UNION ALL SELECT scope, k, 'partial_empty_spec_value' FROM g JOIN w USING (k) WHERE b > 0 AND b < n
UNION ALL SELECT scope, k, 'ambiguous_spec_selector' FROM z WHERE s = '' AND lo <> hi UNION ALL SELECT scope, k, 'missing_required_spec_row' FROM (SELECT DISTINCT scope FROM r) q, w WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.scope = q.scope AND g.k = w.k)""")
def selector_issues(t: Tables) -> DataFrame:
    n = F.col("p_size")
    rows = t.part.where("p_partkey <= 400").select(F.col("p_brand").alias("scope"), F.concat(F.lit("k"), n % 30).alias("row_key"), F.when(n % 4 == 0, "").otherwise((F.col("p_partkey") % 3).cast("string")).alias("slot"), F.when(n % 7 != 0, F.col("p_name")).alias("value"))
    return records.selector_issues(rows, t.rows([("k1",), ("k7",), ("k14",), ("kx",)], "row_key string"))


@query("""
WITH c AS (SELECT CAST(s_suppkey AS VARCHAR) AS target, k, CASE k WHEN 'width' THEN CASE WHEN s_suppkey % 5 = 0 THEN 'wide' ELSE CAST(s_suppkey AS VARCHAR) END WHEN 'title' THEN CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END ELSE 'x' END AS v
  FROM supplier, (SELECT unnest(['width', 'title', 'colour']) AS k) WHERE k <> 'colour' OR s_suppkey % 4 = 0)
SELECT target, k AS key, CASE WHEN k = 'colour' THEN 'unknown_key' WHEN TRY_CAST(v AS DOUBLE) IS NULL THEN 'not_a_number' ELSE 'out_of_range' END AS code FROM c WHERE k = 'colour' OR k = 'width' AND (TRY_CAST(v AS DOUBLE) IS NULL OR v::DOUBLE NOT BETWEEN 2 AND 50)
UNION ALL SELECT target, 'title', 'missing' FROM c WHERE k = 'title' AND v = ''""")
def config_issues(t: Tables) -> DataFrame:
    n, key = F.col("s_suppkey"), F.col("k")
    each = t.supplier.withColumn("k", F.explode(F.array(*map(F.lit, ("width", "title", "colour"))))).where((key != "colour") | (n % 4 == 0))
    value = F.when(key == "width", F.when(n % 5 == 0, "wide").otherwise(n.cast("string"))).when(key == "title", F.when(n % 3 == 0, "").otherwise(F.col("s_name"))).otherwise("x")
    rules = t.rows([("width", "number", 2.0, 50.0, False), ("title", "text", None, None, True)], "key string, kind string, least double, most double, required boolean")
    return records.config_issues(each.select(n.cast("string").alias("target"), key.alias("key"), value.alias("value")), rules)


@query("""
SELECT 'orders' AS subject, 'snapshot_missing' AS code UNION ALL SELECT DISTINCT p_brand || '/' || p_size, 'no_rows' FROM part WHERE (p_brand, p_size) NOT IN (SELECT (p_brand, p_size) FROM part WHERE p_retailprice > 1200)""")
def data_doctor(t: Tables) -> DataFrame:
    return records.doctor(t.rows([("part", "ok"), ("orders", "missing")], "table string, state string"), t.part, t.part.where("p_retailprice > 1200"), ["p_brand", "p_size"])


@query("SELECT CAST(p_partkey AS VARCHAR) AS name, p_brand AS brand, CASE WHEN p_size % 2 = 0 THEN p_type ELSE p_name END AS kind FROM part")
def named_fields(t: Tables) -> DataFrame:
    raw = t.part.select(F.col("p_partkey").cast("string").alias("fld1"), F.col("p_brand").alias("fld2"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(" ").alias("fld3"), F.col("p_name").alias("fld4"))
    return records.named_fields(raw, {"fld1": "name", "fld2": "brand", "fld3": "kind", "fld4": "kind"})


@query("""
WITH x AS (SELECT p_partkey, p_size % 20 + 1 AS n, p_name, p_type, p_brand FROM part)
SELECT p_partkey, chr(9311 + n::INT) AS circled, 2 * length(p_brand) AS wide, p_name || CASE WHEN n % 10 IN (0, 1, 3, 6, 7, 8) THEN ' ' || n || '은' ELSE ' ' || n || '는' END AS particle,
  '&lt;' || p_name || ' &amp; ' || p_brand || '&gt;' AS html, p_name AS link, p_name || ' x ' || p_brand AS filled, round(100.0 * n / 20, 1)::DECIMAL(5, 1) || '%' AS percent, '2024-01-' || lpad(n::VARCHAR, 2, '0') || 'T00:00:00+00:00' AS iso FROM x""")
def text_helpers(t: Tables) -> DataFrame:
    p = t.part.withColumn("n", F.col("p_size") % 20 + 1)
    n = F.col("n").cast("string")
    return p.select(
        "p_partkey", text.circled(F.col("n")).alias("circled"), text.display_width(F.regexp_replace("p_brand", "(?s).", "漢")).cast("long").alias("wide"), text.with_particle(F.concat_ws(" ", "p_name", n), "은", "는").alias("particle"),
        text.escaped(F.concat(F.lit("<"), "p_name", F.lit(" & "), "p_brand", F.lit(">")), "html").alias("html"), text.unlinked(F.concat(F.lit("["), "p_name", F.lit("](http://x.y/z)")))["text"].alias("link"),
        text.substituted(F.lit("{{a}} x {{b}}"), F.create_map(F.lit("a"), F.col("p_name"), F.lit("b"), F.col("p_brand"))).alias("filled"), values.percent_text(F.col("n"), F.lit(20)).alias("percent"),
        values.iso_seconds(F.concat(F.lit("2024-01-"), F.lpad(n, 2, "0")).cast("timestamp")).alias("iso"),
    )
