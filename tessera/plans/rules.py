"""Quality rules, text functions, queue state and the event stream on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text, values
from tessera.operators import quality, queue
from tessera.plans.registry import Tables, query
from tessera.streaming import events as streams


@query("""
SELECT doc_id, len(regexp_extract_all(text, '[àâäéèêëîïôöùûüçñáíóúßÀÂÄÉÈÊËÎÏÔÖÙÛÜÇÑÁÍÓÚ]')) AS accented, len(regexp_extract_all(text, '\\p{Latin}')) AS latin,
  CASE WHEN len(regexp_extract_all(text, '\\p{L}')) > 0 THEN len(regexp_extract_all(text, '\\p{Latin}')) / len(regexp_extract_all(text, '\\p{L}')) END AS ratio FROM documents WHERE text IS NOT NULL""")
def script_ratio(t: Tables) -> DataFrame:
    return t.documents.where("text is not null").select("doc_id", F.regexp_count("text", F.lit("[àâäéèêëîïôöùûüçñáíóúßÀÂÄÉÈÊËÎÏÔÖÙÛÜÇÑÁÍÓÚ]")).alias("accented"), text.script_count("text", "latin").alias("latin"), text.script_ratio("text", "latin").alias("ratio"))


@query("""
WITH w(word) AS (VALUES (' the '), (' and '), (' of '))
SELECT CAST(doc_id AS VARCHAR) AS ref, lang, trim(word) AS word FROM documents CROSS JOIN w WHERE lang IN ('fr', 'de', 'es') AND contains(text, word)""")
def residue_tokens(t: Tables) -> DataFrame:
    own = t.documents.select("doc_id", *[F.when(F.col("lang") == c, F.col("text")).alias(c) for c in ("fr", "de", "es")])
    found = quality.residue(own, "doc_id", {c: c for c in ("fr", "de", "es")}, [" the ", " and ", " of "])
    return found.select("ref", "lang", F.trim(F.get_json_object("evidence", "$.word")).alias("word"))


@query("""
WITH h AS (
  SELECT doc_id, lang, 'R1' AS rule_id, unnest(regexp_extract_all(regexp_replace(text, 'the and', '', 'g'), '[Tt]h[ae][a-z]*')) AS hit FROM documents WHERE lang = 'en'
  UNION ALL SELECT doc_id, lang, 'R2', unnest(regexp_extract_all(text, 'que[a-z]*')) FROM documents WHERE lang = 'fr')
SELECT CAST(doc_id AS VARCHAR) AS ref, lang, rule_id, hit, count(*) AS n FROM h GROUP BY ALL""")
def terminology_rules(t: Tables) -> DataFrame:
    rules = t.rows([("R1", "EN", "[Tt]h[ae][a-z]*", "the and", "x"), ("R2", "fr", "que[a-z]*", "", "y")], "rule_id string, lang string, deprecated_regex string, allow_regex string, preferred string")
    found = quality.terminology(t.documents, "doc_id", "text", "lang", rules)
    return found.select("ref", "lang", F.get_json_object("evidence", "$.rule_id").alias("rule_id"), F.get_json_object("evidence", "$.hit").alias("hit")).groupBy("ref", "lang", "rule_id", "hit").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS ref, n AS name FROM part CROSS JOIN (VALUES ('Brand#1', 'red bolt'), ('Brand#1', 'bolt'), ('Brand#2', 'red')) v(o, n)
WHERE o <> p_brand AND contains(CASE p_brand WHEN 'Brand#1' THEN replace(replace(p_name || ' red bolt', 'red bolt', ' '), 'bolt', ' ') WHEN 'Brand#2' THEN replace(p_name || ' red bolt', 'red', ' ') ELSE p_name || ' red bolt' END, n)""")
def identity_drift(t: Tables) -> DataFrame:
    names = t.rows([("Brand#1", "red bolt"), ("Brand#1", "bolt"), ("Brand#2", "red")], "owner string, name string")
    found = quality.foreign_identity(t.part.withColumn("said", F.concat("p_name", F.lit(" red bolt"))), "p_partkey", "said", "p_brand", names)
    return found.select("ref", F.get_json_object("evidence", "$.name").alias("name"))


@query("""
WITH l AS (SELECT p_partkey, unnest([p_type || ': ' || p_name, p_name, 'On: ' || p_name]) AS line FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS ref, string_split(line, ':')[1] AS prefix FROM l WHERE contains(line, ':') AND lower(trim(string_split(line, ':')[1])) NOT IN ('on', 'standard') AND length(string_split(line, ':')[1]) <= 24""")
def status_prefixes(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat_ws("\n", F.concat_ws(": ", "p_type", "p_name"), "p_name", F.concat_ws(": ", F.lit("On"), "p_name")).alias("icons"))
    found = quality.status_prefixes(rows, "p_partkey", "icons", ["ON", "Standard"])
    return found.select("ref", F.get_json_object("evidence", "$.prefix").alias("prefix"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS ref, unnest(list_filter([
  CASE WHEN p_partkey % 5 = 0 THEN 'missing_source_lang' END, CASE WHEN p_partkey % 5 = 1 THEN 'invalid_source_lang' END, CASE WHEN p_size = 1 THEN 'missing_row_key' END,
  CASE WHEN p_size <> 1 THEN 'invalid_row_key' END, CASE WHEN p_type = 'SMALL' THEN 'missing_value' END, CASE WHEN p_size = 3 THEN 'invalid_line_order' END], lambda x: x IS NOT NULL)) AS message FROM part""")
def spec_issues(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 5 == 0, "").when(F.col("p_partkey") % 5 == 1, "xx").otherwise("EN").alias("source_lang"), F.when(F.col("p_size") == 1, " ").otherwise(F.col("p_brand")).alias("row_key"),
        F.col("p_name").alias("label"), F.lit("").alias("param"), F.when(F.col("p_type") == "SMALL", None).otherwise("1 W").alias("value"), F.lit("a.b").alias("slot_key"), F.lit("2").alias("section_order"), F.when(F.col("p_size") == 3, "0").otherwise("1.0").alias("line_order"),
    )
    return quality.spec_issues(rows).select("ref", "message")


@query("""
WITH f AS (SELECT event_type AS rule, CASE WHEN value > 30 THEN 'FAIL' WHEN value > 10 THEN 'WARN' ELSE 'PASS' END AS severity FROM events)
SELECT rule, severity, count(*) AS n, 'FAIL' AS status FROM f GROUP BY rule, severity""")
def severity_counts(t: Tables) -> DataFrame:
    level = F.when(F.col("value") > 30, "FAIL").when(F.col("value") > 10, "WARN").otherwise("PASS")
    return quality.severity_counts(t.events.select(F.col("event_type").alias("rule"), level.alias("severity")))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS ref, c_mktsegment AS field FROM customer
WHERE c_nationkey <> 3 AND NOT (c_nationkey = 4 AND c_mktsegment = 'BUILDING')""")
def known_exceptions(t: Tables) -> DataFrame:
    f = t.customer.select(F.col("c_nationkey").cast("string").alias("rule"), F.col("c_custkey").cast("string").alias("ref"), F.col("c_mktsegment").alias("field"))
    known = t.rows([("3", ""), ("4", "BUILDING")], "rule string, field string")
    return quality.without_known(f, known, ["rule", "field"]).select("ref", "field")


@query("""
SELECT p_brand AS document_key, CASE p_brand WHEN 'Brand#1' THEN 'wifi' ELSE 'solar' END AS page, CASE p_brand WHEN 'Brand#1' THEN 'missing' ELSE 'forbidden' END AS what FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#2'))""")
def capability_pages(t: Tables) -> DataFrame:
    pages = t.rows([("Brand#2", "solar"), ("Brand#3", "wifi"), ("Brand#1", "solar")], "document_key string, page string")
    capabilities = t.part.where("p_brand in ('Brand#1', 'Brand#2', 'Brand#3')").select(F.col("p_brand").alias("document_key"), F.when(F.col("p_brand") == "Brand#2", "sun").otherwise("net").alias("capability"), (F.col("p_brand") != "Brand#2").alias("has")).distinct()
    rules = t.rows([("net", "wifi", True, True), ("sun", "solar", False, True)], "capability string, page string, required boolean, forbidden boolean")
    found = quality.capability_pages(pages, capabilities, rules)
    return found.select(F.col("ref").alias("document_key"), F.col("field").alias("page"), F.when(F.col("message").contains("missing"), "missing").otherwise("forbidden").alias("what"))


@query("""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'image_asset_delta' WHEN event_id % 11 = 0 AND rev THEN 'source_table_suggestion' WHEN event_id % 11 = 0 THEN 'needs_human_mapping'
  WHEN event_type = 'error' AND rev THEN 'source_table_suggestion' WHEN event_type = 'error' THEN 'needs_human_mapping' WHEN rev AND event_type = 'click' THEN 'needs_human_mapping'
  WHEN rev AND user_id % 4 = 0 THEN 'needs_human_mapping' WHEN rev THEN 'repo_review_text' ELSE 'repo_template_text' END AS route FROM (SELECT *, user_id % 2 = 0 AS rev FROM events)""")
def change_routes(t: Tables) -> DataFrame:
    image = F.col("event_id") % 7 == 0
    old = F.when(image, "[image]").when(F.col("event_type") == "click", "use the output").otherwise("some words")
    new = F.when(image, "[image] [image]").when(F.col("event_type") == "click", "use the button").when(F.col("event_type") == "error", "now 20 W").otherwise("other words")
    r = quality.route(F.when(F.col("user_id") % 2 == 0, "review").otherwise("template"), old, new, F.lit("paragraph"), F.when(F.col("event_id") % 11 == 0, "Spec_Master"), F.lit(False), (F.col("user_id") % 4 == 0).cast("int") * 2)
    return t.events.select("event_id", r["route"].alias("route"))


@query("""
WITH l AS (SELECT event_id, user_id, event_type, event_id % 2 = 0 AS ok FROM events WHERE value > 5)
SELECT 'h' || user_id || event_type AS delta_hash, 'en' AS lang, 'old ' || min(event_id) AS old_text, 'new ' || min(event_id) AS new_text FROM l WHERE ok GROUP BY user_id, event_type""")
def memory_candidates(t: Tables) -> DataFrame:
    rows = t.events.where("value > 5").select(
        F.when(F.col("event_id") % 2 == 0, "accepted_as_proposed").otherwise("rejected").alias("final_status"), F.lit("repo_review_text").alias("route_class"), F.lit("en").alias("lang"), F.concat(F.lit("h"), "user_id", "event_type").alias("delta_hash"),
        F.concat(F.lit("old "), "event_id").alias("machine_text"), F.concat(F.lit("new "), "event_id").alias("reviewer_text"), F.lit("").alias("final_text"), F.col("event_id").alias("pos"),
    )
    return quality.memory_candidates(rows)


@query("""
SELECT d.doc_id AS doc, CASE WHEN n_chars < 100 THEN 'error' WHEN quality IS NULL THEN 'no_baseline' WHEN quality = n_chars % 2 THEN 'synced' ELSE 'pending' END AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def document_sync(t: Tables) -> DataFrame:
    docs = t.documents.select(F.col("doc_id").alias("doc"), (F.col("n_chars") % 2).cast("string").alias("hash"), (F.col("n_chars") < 100).alias("failed"))
    return quality.document_sync(docs, t.labels.select(F.col("doc_id").alias("doc"), F.col("quality").cast("string").alias("hash")))


@query()
def revision_verdicts(t: Tables) -> DataFrame:
    """What landed of a proposed text: containment first, then the fuzzy stage."""
    said = F.regexp_replace("text", "e", "ee")
    hay = F.when(F.col("turn") % 5 == 4, None).when(F.col("turn") % 5 == 3, F.concat(said, F.lit(" and more"))).when(F.col("turn") % 5 == 2, F.concat(F.lit("so "), "text")).when(F.col("turn") % 5 == 1, F.regexp_replace(said, "ee$|x", "")).otherwise(F.reverse("text"))
    c = t.conversations.select("conv_id", "turn", F.col("text").alias("machine_text"), said.alias("reviewer_text"), hay.alias("haystack"))
    return quality.verdicts(c).select("conv_id", "turn", "verdict")


@query("""
SELECT p_partkey, CASE WHEN contains(k, '_') THEN regexp_extract(k, '^(.*)_[^_]*$', 1) ELSE k END AS model, CASE WHEN contains(k, '_') THEN regexp_extract(k, '_([^_]*)$', 1) ELSE '' END AS region,
  lpad(p_size::VARCHAR, 3, '0') AS padded, replace(lower(p_name || ' / ' || p_brand), ' / ', '_').replace(' ', '_').replace('#', '_') AS slugged, p_name || ': ' || p_type AS pair, p_size || ' kg' AS weight
FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'M_' || p_type || '_EU' ELSE p_type END AS k FROM part)""")
def text_functions(t: Tables) -> DataFrame:
    k = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("M_"), "p_type", F.lit("_EU"))).otherwise(F.col("p_type"))
    cut = text.split_key(k)
    size = F.col("p_size").cast("string")
    return t.part.select("p_partkey", cut["model"].alias("model"), cut["region"].alias("region"), text.zero_padded(size, 3).alias("padded"), text.slug(F.concat_ws(" / ", "p_name", "p_brand")).alias("slugged"), text.param_value("p_name", "p_type", F.lit("en")).alias("pair"), text.unit_value(size, F.lit("kg")).alias("weight"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'About ' || p_size || ' kg' WHEN 1 THEN p_size || ' cycles to 70%+ capacity' WHEN 2 THEN p_size || ' V⎓' || (p_size + 1) || ' A max.' ELSE 'odd ' || p_size END AS value,
  CASE WHEN p_size % 4 = 3 THEN 'needs_review' ELSE 'transformed' END AS status FROM part""")
def unit_transforms(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    op = F.element_at(F.array(*map(F.lit, ("weight", "cycle_life", "dc12", "capacity"))), (F.col("p_size") % 4 + 1).cast("int"))
    raw = F.when(op == "weight", F.concat(size, F.lit(" Kg"))).when(op == "cycle_life", F.concat(size, F.lit(" cycles"))).when(op == "dc12", F.concat(size, F.lit(" V = "), F.col("p_size") + 1, F.lit(" A"))).otherwise(F.concat(F.lit("odd "), size))
    made = values.converted(op, raw, F.lit(""), F.lit("EU"))
    return t.part.select("p_partkey", made["value"].alias("value"), made["status"].alias("status"))


_RESULT = """CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'Success | version=1 | built_at=' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN 'FAILED | built_at=' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 3 THEN 'Done | built_at=nonsense'
  WHEN 4 THEN 'RUNNING | claim_token=t' || user_id || ' | claim_expires_at=' || strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') ELSE 'RUNNING | claim_token= | claim_expires_at=2099-01-01T00:00:00Z' END"""


def _results(t: Tables) -> DataFrame:
    at = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    n, ts = F.col("event_id") % 6, F.col("ts").cast("timestamp")
    result = (
        F.when(n == 0, "").when(n == 1, F.concat(F.lit("Success | version=1 | built_at="), at(ts))).when(n == 2, F.concat(F.lit("FAILED | built_at="), at(ts))).when(n == 3, "Done | built_at=nonsense")
        .when(n == 4, F.concat(F.lit("RUNNING | claim_token=t"), "user_id", F.lit(" | claim_expires_at="), at(ts + F.expr("INTERVAL 2 HOURS")))).otherwise("RUNNING | claim_token= | claim_expires_at=2099-01-01T00:00:00Z")
    )
    return t.events.withColumn("result", result)


@query(f"""
WITH r AS (SELECT *, {_RESULT} AS result FROM events)
SELECT event_id, CASE WHEN event_id % 10 = 9 THEN 'not_requested' WHEN event_id % 6 IN (1, 2) AND date_trunc('second', ts) >= TIMESTAMP '2024-01-15' THEN CASE event_id % 6 WHEN 1 THEN 'fresh_success' ELSE 'fresh_failure' END
  WHEN event_id % 6 IN (1, 2) THEN 'stale_result' WHEN ts >= TIMESTAMP '2024-01-20' THEN 'writeback_pending' WHEN result = '' THEN 'pending' ELSE 'stale_result' END AS status FROM r""")
def freshness_status(t: Tables) -> DataFrame:
    since = F.when(F.col("event_id") % 10 == 9, "").otherwise("2024-01-15T00:00:00Z")
    started = F.when(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"), "1705800000000").otherwise("0")
    return _results(t).select("event_id", values.freshness("result", started, since)["status"].alias("status"))


@query("SELECT event_id, event_id % 6 = 4 AND date_trunc('second', ts) + INTERVAL 2 HOUR > TIMESTAMP '2024-01-15' AS active FROM events")
def claim_active(t: Tables) -> DataFrame:
    return _results(t).select("event_id", values.claim_active("result", F.lit("2024-01-15 00:00:00").cast("timestamp")).alias("active"))


@query("SELECT event_id AS record_id FROM events WHERE value > 10 AND event_type <> 'view' AND NOT (event_id % 6 = 4 AND date_trunc('second', ts) + INTERVAL 2 HOUR > TIMESTAMP '2024-01-15')")
def pending_queue(t: Tables) -> DataFrame:
    rows = _results(t).select(F.col("event_id").alias("record_id"), F.when(F.col("value") > 10, "Y").otherwise("").alias("trigger"), F.lit("").alias("immediate"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("workflow_action"), "result")
    return queue.pending(rows, F.lit("2024-01-15 00:00:00").cast("timestamp")).select("record_id")


@query("SELECT event_id, user_id, bool_or(event_id % 6 = 4 AND date_trunc('second', ts) + INTERVAL 2 HOUR > TIMESTAMP '2024-01-30') OVER (PARTITION BY user_id) AS blocked FROM events")
def blocked_groups(t: Tables) -> DataFrame:
    return queue.blocked_groups(_results(t).select("event_id", "user_id", "result"), ["user_id"], F.lit("2024-01-30 00:00:00").cast("timestamp")).drop("result")


@query("SELECT user_id, event_type AS state, event_id AS pos FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_state(t: Tables) -> DataFrame:
    return queue.latest_state(t.events.select("user_id", F.col("event_type").alias("state"), "ts", F.col("event_id").alias("pos")), "user_id", "ts").drop("ts")


@query("""
SELECT c_custkey AS request_id, CASE WHEN n = 1 THEN k END AS record_id, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' WHEN c_nationkey % 2 = 0 AND c_custkey % 2 = 0 THEN 'confirm' ELSE 'unique' END AS status
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey""")
def resolved_actions(t: Tables) -> DataFrame:
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_nationkey") % 2 == 0, "publish").otherwise("draft").alias("action"), (F.col("c_custkey") % 2 == 1).alias("confirmed"))
    return queue.resolved_actions(asked, t.orders.where("o_orderstatus = 'P'").select("o_custkey", F.col("o_orderkey").alias("record_id")), ["o_custkey"])


@query("""
SELECT c_custkey AS request_id, r.event_id AS run_id FROM customer JOIN events r ON r.user_id = c_custkey AND r.ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 15 SECOND
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY r.ts, r.event_id) = 1""")
def matching_runs(t: Tables) -> DataFrame:
    asked = t.customer.select(F.col("c_custkey").alias("request_id"), F.concat(F.lit("n"), "c_custkey").alias("nonce"), F.lit("2024-01-10 00:00:00").cast("timestamp_ntz").alias("dispatched"))
    runs = t.events.select(F.col("event_id").alias("run_id"), F.concat(F.lit("run (n"), "user_id", F.lit(") of "), "event_type").alias("title"), F.col("ts").alias("created"))
    return queue.matching_runs(asked, runs)


@query("SELECT event_id, event_type, 1::BIGINT AS n FROM events WHERE event_type IN ('click', 'purchase')")
def stream_dedup(t: Tables) -> DataFrame:
    """events twice over as a stream of files, each id kept once, into files; then read back."""
    from pyspark.sql import types as T

    raw = t.events
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in raw.schema])
    lines = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events.parquet*")
    twice = lines.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("at", F.col("ts").cast("timestamp")).where("event_type in ('click', 'purchase')")
    out = t.folder()
    once = streams.deduplicated(twice.select("event_id", "event_type", "at"), "event_id", "at", "60 days")
    once.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(once.schema).parquet(f"{out}/rows").groupBy("event_id", "event_type").agg(F.count("*").alias("n"))
