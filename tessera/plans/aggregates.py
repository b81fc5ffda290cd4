"""Aggregates, facets, inventories and search on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import cells, collapsed, emails, filled
from tessera.operators import metrics, search
from tessera.plans.registry import Tables, query


@query("SELECT substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS month, count(*) AS n FROM orders GROUP BY 1")
def monthly_counts(t: Tables) -> DataFrame:
    return metrics.monthly_counts(t.orders, "o_orderdate")


@query("""
WITH r AS (SELECT lang, CASE WHEN quality IS NOT NULL THEN n_chars * quality END AS m, CASE WHEN toxic IS NOT NULL THEN n_chars END AS t FROM documents LEFT JOIN labels USING (doc_id))
SELECT lang, count(*) AS runs, count(*) FILTER (m IS NULL OR t IS NULL) AS runs_without_counters, sum(m)::BIGINT AS matched, sum(t)::BIGINT AS total, grouping(lang) > 0 AS overall,
  round(sum(m)::DOUBLE / nullif(sum(t), 0), 4) AS hit_rate FROM r GROUP BY GROUPING SETS ((lang), ())""")
def hit_rate_by_group(t: Tables) -> DataFrame:
    runs = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left").select("lang", (F.col("n_chars") * F.col("quality")).alias("units_matched"), F.when(F.col("toxic").isNotNull(), F.col("n_chars")).alias("units_total"))
    return metrics.hit_rates(runs, ["lang"])


@query("""
WITH e AS (SELECT event_type AS route, CASE user_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'accepted_as_proposed' WHEN 2 THEN 'edited_further' WHEN 3 THEN 'rejected' ELSE 'pending' END AS status FROM events)
SELECT route, count(*) AS total, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status <> 'pending') AS decided, count(*) FILTER (status = 'accepted_as_proposed') AS accepted,
  round(count(*) FILTER (status <> 'pending') / count(*), 4) AS reflow_rate, round(count(*) FILTER (status = 'accepted_as_proposed') / nullif(count(*) FILTER (status <> 'pending'), 0), 4) AS acceptance_rate
FROM e GROUP BY GROUPING SETS ((route), ())""")
def ledger_rates(t: Tables) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ("pending", "accepted_as_proposed", "edited_further", "rejected", ""))), (F.col("user_id") % 5 + 1).cast("int"))
    return metrics.ledger_rates(t.events.select(F.col("event_type").alias("route_class"), status.alias("final_status")))


@query("""
WITH g AS (SELECT user_id, event_type, count(DISTINCT CAST(ts AS DATE)) AS d FROM events WHERE value > 15 GROUP BY ALL)
SELECT count(*) AS texts, count(*) FILTER (d > 1) AS repeated, round(count(*) FILTER (d > 1) / count(*), 4) AS rate FROM g""")
def second_revision_rate(t: Tables) -> DataFrame:
    rows = t.events.where("value > 15").select(F.concat_ws(" ", "user_id", "event_type").alias("text"), F.to_date("ts").cast("string").alias("run"))
    return metrics.second_revision_rate(rows, "text", "run")


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'both', v, count(*) FROM (SELECT unnest([lang, source]) AS v FROM documents) GROUP BY v")
def facet_counts(t: Tables) -> DataFrame:
    return metrics.facet_counts(t.documents, {"lang": F.array("lang"), "source": F.array("source"), "both": F.array("lang", "source")})


@query("SELECT count(*) AS rows, (SELECT count(DISTINCT x) FROM (SELECT unnest(string_split(p_name, ' ')) AS x FROM part)) AS distinct_models, max(p_size) AS last_updated FROM part")
def overview(t: Tables) -> DataFrame:
    return metrics.overview(t.part, F.split("p_name", " "), "p_size")


@query("SELECT 'p_brand' AS dimension, count(DISTINCT p_brand) AS n FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part")
def coverage(t: Tables) -> DataFrame:
    return metrics.coverage(t.part, ["p_brand", "p_type", "p_name"])


@query("SELECT CAST(user_id AS VARCHAR) AS source, count(*) AS n FROM events WHERE event_type IN ('error', 'click') GROUP BY 1 ORDER BY n DESC, source LIMIT 20")
def topk_corrections(t: Tables) -> DataFrame:
    return metrics.top_counts(t.events.where("event_type in ('error', 'click')").select(F.col("user_id").cast("string").alias("source")), "source")


@query("""
WITH k AS (SELECT md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS key, doc_id FROM documents)
SELECT key, n, doc_id FROM k JOIN (SELECT key, count(*) AS n FROM k GROUP BY key HAVING count(*) > 1) USING (key)""")
def duplicate_keys(t: Tables) -> DataFrame:
    return metrics.duplicate_keys(t.documents, F.md5(F.lower(collapsed("text"))), "doc_id")


@query("SELECT doc_id AS line, first_line FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text, lang) AS first_line FROM documents) WHERE doc_id > first_line")
def exact_duplicates_first_line(t: Tables) -> DataFrame:
    return metrics.exact_repeats(t.documents, ["text", "lang"], "doc_id")


@query("SELECT lang, count(*) AS n FROM (SELECT DISTINCT ON (text, lang) lang, text FROM documents) GROUP BY lang")
def exact_duplicates_removed(t: Tables) -> DataFrame:
    return metrics.without_repeats(t.documents, ["text", "lang"], "doc_id").groupBy("lang").agg(F.count("*").alias("n"))


@query("""
WITH v AS (SELECT DISTINCT conv_id, CASE role WHEN 'user' THEN 'a' WHEN 'assistant' THEN 'b' END AS s, lower(text) AS v FROM conversations WHERE role IN ('user', 'assistant')),
g AS (SELECT conv_id, v, min(s) AS lo, max(s) AS hi FROM v WHERE v IS NOT NULL GROUP BY ALL)
SELECT conv_id, count(*) FILTER (lo = 'a') AS n_a, count(*) FILTER (hi = 'b') AS n_b FROM g GROUP BY conv_id
HAVING count(*) FILTER (lo = 'a') > 0 AND count(*) FILTER (hi = 'b') > 0 AND count(*) FILTER (lo <> hi) = 0""")
def value_set_disjoint(t: Tables) -> DataFrame:
    side = F.when(F.col("role") == "user", "a").when(F.col("role") == "assistant", "b")
    return metrics.disjoint_value_sets(t.conversations, ["conv_id"], side, F.lower("text"))


@query("""
WITH e AS (SELECT event_type, value FROM events)
SELECT count(*) FILTER (event_type = 'purchase') AS passed, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'error') AS failed,
  round(count(*) FILTER (event_type = 'purchase') / count(*) FILTER (event_type IN ('purchase', 'view', 'error')), 4) AS coverage,
  count(*) FILTER (event_type = 'view') <= 100 AS skip_ok, count(*) FILTER (event_type = 'error') <= 1000000 AS fail_ok FROM e""")
def outcome_rates(t: Tables) -> DataFrame:
    outcome = F.when(F.col("event_type") == "purchase", "PASS").when(F.col("event_type") == "view", "skip").when(F.col("event_type") == "error", "FAIL")
    return metrics.outcome_rates(t.events.select(outcome.alias("outcome")), t.rows([(100, 1000000)], "skipped long, failed long"))


@query("""
WITH e AS (
  SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target, CAST(page_id AS VARCHAR) AS s FROM pages
  UNION ALL SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))), CAST(doc_id AS VARCHAR) FROM documents),
p AS (SELECT target, s, count(*) AS c FROM e WHERE trim(target) <> '' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY s) AS r FROM p)
SELECT target, sum(c)::BIGINT AS occurrences, count(*) AS n_sources, string_agg(s, '; ' ORDER BY s) FILTER (r <= 3) || CASE WHEN count(*) > 3 THEN '; +' || (count(*) - 3) || ' more' ELSE '' END AS sources FROM r GROUP BY target""")
def url_email_inventory(t: Tables) -> DataFrame:
    links = t.pages.select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1).alias("found")).withColumnRenamed("page_id", "s")
    mail = t.documents.select(F.col("doc_id").alias("s"), emails("text").alias("found"))
    return metrics.inventory(links.unionByName(mail), "s", F.col("found"))


@query("""
SELECT cell, count(*) AS n FROM (
  SELECT trim(regexp_replace(regexp_replace(unnest(regexp_split_to_array(html, '(?i)\\||<br\\s*/?>|</t[dh]>')), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS cell FROM pages) WHERE cell <> '' GROUP BY cell""")
def cell_split(t: Tables) -> DataFrame:
    return t.pages.select(F.explode(cells("html")).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))


@query("""
WITH n AS (SELECT p_name AS key, p_type AS lang, p_brand AS text, count(*) AS n FROM part GROUP BY ALL),
b AS (SELECT key, lang, count(*) AS variants, max(n) AS most FROM n GROUP BY ALL HAVING count(*) > 1)
SELECT key, lang, variants, CASE WHEN count(*) = 1 THEN min(text) END AS suggestion FROM n JOIN b USING (key, lang) WHERE n.n = most GROUP BY key, lang, variants""")
def drift_variants(t: Tables) -> DataFrame:
    return metrics.drift_variants(t.part.select(F.col("p_name").alias("key"), F.col("p_type").alias("lang"), F.col("p_brand").alias("text")))


@query("""
SELECT line, count(*) AS n_labels, count(*) > 1 AS shared FROM (
  SELECT DISTINCT trim(unnest(string_split(text, chr(10)))) AS line, source FROM documents) WHERE line <> '' GROUP BY line""")
def shared_lines(t: Tables) -> DataFrame:
    lines = t.documents.select("source", F.explode(F.split("text", "\n")).alias("l"))
    return metrics.shared_by(lines, F.trim("l"), "source")


@query("""
SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS l_quantity, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS kinds, string_agg(DISTINCT 'p' || l_partkey, ',' ORDER BY 'p' || l_partkey) AS paths FROM lineitem GROUP BY l_orderkey""")
def page_rollup(t: Tables) -> DataFrame:
    return metrics.page_rollup(t.lineitem.withColumn("path", F.concat(F.lit("p"), F.col("l_partkey"))), ["l_orderkey"], "l_returnflag", "path", ["l_quantity"])


@query("""
SELECT o_orderpriority, o_orderkey, count(*) AS lines, string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS text
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def nested_sections(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderpriority", "o_orderkey").join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    return metrics.nested_sections(rows, "o_orderpriority", "o_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT user_id, event_type, min(event_id) AS first_pos, count(*) AS n, arg_min(CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'l' || (event_id % 4) END, event_id) FILTER (event_id % 3 <> 0) AS lang,
  bool_or(value > 60) AS force, min(event_id % 2) = max(event_id % 2) AS same_version FROM events GROUP BY ALL""")
def queue_groups(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.col("event_id").alias("pos"), F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.concat(F.lit("l"), F.col("event_id") % 4)).alias("lang"), (F.col("value") > 60).alias("force"), (F.col("event_id") % 2).alias("version"))
    return metrics.grouped_queue(rows, ["user_id", "event_type"])


@query("SELECT p_brand, p_partkey, CASE WHEN ntile(2) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) = 1 THEN 'left' ELSE 'right' END AS side FROM part")
def ntile_split(t: Tables) -> DataFrame:
    return metrics.split_in_two(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], ["p_retailprice", "p_partkey"]).drop("p_retailprice")


@query("SELECT p_partkey, p_name || CASE WHEN row_number() OVER w > 1 THEN ' #' || row_number() OVER w ELSE '' END AS shown FROM part WINDOW w AS (PARTITION BY p_brand, p_name ORDER BY p_partkey)")
def numbered_repeats(t: Tables) -> DataFrame:
    return metrics.numbered_repeats(t.part, ["p_brand"], "p_name", "p_partkey").select("p_partkey", "shown")


@query("""
SELECT p_brand AS document_key, lpad(min(p_partkey)::VARCHAR, 9, '0') AS project, CASE WHEN arg_min(p_size, p_partkey) > 25 THEN 'TRUE' ELSE 'FALSE' END AS big,
  CASE WHEN arg_min(p_type, p_partkey) = 'ECONOMY' THEN 'TRUE' ELSE 'FALSE' END AS cheap FROM part WHERE p_brand <> 'Brand#3' GROUP BY p_brand""")
def capability_matrix(t: Tables) -> DataFrame:
    rows = t.part.select(F.when(F.col("p_brand") != "Brand#3", F.col("p_brand")).otherwise(" ").alias("document_key"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("project"), F.when(F.col("p_size") > 25, "Yes").otherwise("").alias("big"), F.when(F.col("p_type") == "ECONOMY", "1").otherwise("no").alias("cheap"))
    return metrics.capability_matrix(rows, ["big", "cheap"])


@query("""
WITH q AS (SELECT *, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS src, lower(p_name || ' ' || p_type || ' ' || p_name || ' ' || p_brand) AS blob FROM part WHERE p_type <> 'SMALL'),
s AS (SELECT p_partkey,
  CASE WHEN src = 'red widget' THEN 180 ELSE 0 END + CASE WHEN src = 'red widget' THEN 110 ELSE 0 END + CASE WHEN contains(src, 'red widget') THEN 60 ELSE 0 END + CASE WHEN contains(blob, 'red widget') THEN 40 ELSE 0 END
  + 12 * (contains(src, 'red')::INT + contains(src, 'widget')::INT) + 8 * (contains(blob, 'red')::INT + contains(blob, 'widget')::INT)
  + CASE WHEN contains(blob, 'red') AND contains(blob, 'widget') THEN 24 ELSE 0 END + 12 + 12 + CASE WHEN contains(src, 'red') OR contains(src, 'widget') THEN 10 ELSE 0 END AS score
  FROM q WHERE contains(blob, 'red') OR contains(blob, 'widget'))
SELECT p_partkey AS pos, score FROM s ORDER BY score DESC, p_partkey LIMIT 25""")
def scored_search(t: Tables) -> DataFrame:
    entries = t.part.select(F.col("p_type").alias("row_key"), F.col("p_name").alias("source_text"), F.create_map(F.lit("en"), "p_name", F.lit("fr"), "p_brand").alias("translations"), F.lit("specs").alias("table"), F.col("p_type").alias("section"), F.col("p_partkey").alias("pos"))
    found = search.search_memory(entries.where("section <> 'SMALL'"), "Red  Widget", None, ["specs"], "en", "fr", "fr", 25)
    return found.select("pos", "score")


@query()
def index_search(t: Tables) -> DataFrame:
    """Manuals by scored tokens; the NFKC search form has no SQL counterpart."""
    rows = t.part.select("p_partkey", F.col("p_brand").alias("business_id"), F.split("p_name", " ").alias("models"), F.col("p_name").alias("title"), F.array("p_type").alias("kind"))
    return search.search_index(rows, "overview Brand#12 hot", ["business_id", "models"], ["title"], {"kind": ["ECONOMY", "STANDARD"]}, 20, ["p_partkey"]).select("p_partkey", "score")


@query("SELECT doc_id, regexp_matches(text, '@') AS has_mail, length(trim(text)) > 0 AS has_text FROM documents WHERE text IS NOT NULL")
def text_facts(t: Tables) -> DataFrame:
    return t.documents.where("text is not null").select("doc_id", F.col("text").contains("@").alias("has_mail"), filled("text").isNotNull().alias("has_text"))
