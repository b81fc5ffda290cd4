"""Diffs, plans and gates on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.udfs import partial_ratio, search_form
from tessera.operators import diff
from tessera.plans.registry import Tables, query


@query("""
WITH n AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16'), b AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16')
SELECT coalesce(n.user_id, b.user_id) AS user_id, coalesce(n.event_type, b.event_type) AS event_type, CASE WHEN b.user_id IS NULL THEN 'new' WHEN n.user_id IS NULL THEN 'stale' ELSE 'known' END AS state
FROM n FULL JOIN b ON n.user_id = b.user_id AND n.event_type = b.event_type""")
def ratchet_new_known_stale(t: Tables) -> DataFrame:
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    return diff.ratchet(t.events.where(late), t.events.where(~late), ["user_id", "event_type"])


@query("""
SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)
UNION ALL SELECT doc_id, 'extra' FROM labels WHERE toxic = 0 AND doc_id NOT IN (SELECT doc_id FROM documents)""")
def completeness_anti(t: Tables) -> DataFrame:
    return diff.missing_and_extra(t.documents, t.labels.where("toxic = 0"), ["doc_id"])


@query("""
SELECT l.lang, s.source FROM (SELECT DISTINCT lang FROM documents) l CROSS JOIN (SELECT DISTINCT source FROM documents) s
EXCEPT SELECT lang, source FROM documents WHERE n_chars > 2000""")
def missing_pairs(t: Tables) -> DataFrame:
    return diff.missing_pairs(t.documents, t.documents, t.documents.where("n_chars > 2000"), "lang", "source")


_DIFF_SQL = """
WITH o AS (SELECT conv_id // 2 AS pair, turn AS p, role AS k, CASE WHEN turn % 3 = 1 THEN 'r' || turn ELSE '' END AS s, text AS v FROM conversations WHERE conv_id % 2 = 0),
n AS (SELECT conv_id // 2 AS pair, turn AS p, CASE WHEN turn % 4 = 3 THEN role || '2' ELSE role END AS k, CASE WHEN turn % 3 = 1 THEN 'r' || turn ELSE '' END AS s, text AS v FROM conversations WHERE conv_id % 2 = 1),
p1 AS (SELECT a.pair, a.p AS op, b.p AS np FROM (SELECT *, row_number() OVER (PARTITION BY pair, k ORDER BY p) AS i FROM o) a JOIN (SELECT *, row_number() OVER (PARTITION BY pair, k ORDER BY p) AS i FROM n) b ON a.pair = b.pair AND a.k = b.k AND a.i = b.i),
o1 AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM p1 WHERE p1.pair = o.pair AND p1.op = o.p)), n1 AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM p1 WHERE p1.pair = n.pair AND p1.np = n.p)),
p2 AS (SELECT a.pair, a.p AS op, b.p AS np FROM (SELECT *, row_number() OVER (PARTITION BY pair, s ORDER BY p) AS i FROM o1 WHERE s <> '') a JOIN (SELECT *, row_number() OVER (PARTITION BY pair, s ORDER BY p) AS i FROM n1 WHERE s <> '') b ON a.pair = b.pair AND a.s = b.s AND a.i = b.i),
o2 AS (SELECT * FROM o1 WHERE NOT EXISTS (SELECT 1 FROM p2 WHERE p2.pair = o1.pair AND p2.op = o1.p)), n2 AS (SELECT * FROM n1 WHERE NOT EXISTS (SELECT 1 FROM p2 WHERE p2.pair = n1.pair AND p2.np = n1.p)),
eq AS (SELECT pair FROM (SELECT pair, count(*) AS c FROM o2 GROUP BY pair) JOIN (SELECT pair, count(*) AS d FROM n2 GROUP BY pair) USING (pair) WHERE c = d),
p3 AS (SELECT a.pair, a.p AS op, b.p AS np FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY p) AS i FROM o2 WHERE pair IN (SELECT pair FROM eq)) a JOIN (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY p) AS i FROM n2 WHERE pair IN (SELECT pair FROM eq)) b ON a.pair = b.pair AND a.i = b.i),
al AS (SELECT *, 'key' AS how FROM p1 UNION ALL SELECT *, 'source' FROM p2 UNION ALL SELECT *, 'position' FROM p3)
SELECT al.pair, 'M' AS kind, CASE WHEN o.k = n.k THEN o.k ELSE o.k || ' -> ' || n.k END AS k, o.v AS old_value, n.v AS new_value, how
FROM al JOIN o ON o.pair = al.pair AND o.p = op JOIN n ON n.pair = al.pair AND n.p = np WHERE o.k <> n.k OR o.v <> n.v
UNION ALL SELECT pair, 'D', k, v, NULL, 'left' FROM o2 WHERE pair NOT IN (SELECT pair FROM eq)
UNION ALL SELECT pair, 'A', k, NULL, v, 'left' FROM n2 WHERE pair NOT IN (SELECT pair FROM eq)"""


@query(_DIFF_SQL)
def keyed_diff_amd(t: Tables) -> DataFrame:
    base = t.conversations.select(F.floor(F.col("conv_id") / 2).alias("pair"), F.col("conv_id") % 2 == 1, "role", "turn", F.when(F.col("turn") % 3 == 1, F.concat(F.lit("r"), F.col("turn"))).otherwise("").alias("s"), F.col("text").alias("v")).toDF("pair", "new", "k", "pos", "s", "v")
    new = base.where("new").withColumn("k", F.when(F.col("pos") % 4 == 3, F.concat("k", F.lit("2"))).otherwise(F.col("k")))
    return diff.keyed_diff(base.where("not new"), new, ["pair"], "k", "s", "v")


@query("""
WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS k, CAST(quality AS VARCHAR) AS q, CAST(toxic AS VARCHAR) AS x FROM labels),
s AS (SELECT CAST(doc_id AS VARCHAR) AS k, CASE WHEN n_chars > 600 THEN '1' ELSE '' END AS q, CASE WHEN doc_id % 4 = 0 THEN '1' ELSE '0' END AS x FROM documents WHERE doc_id % 3 <> 0)
SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NULL THEN 'create' WHEN s.k IS NULL THEN 'extra' WHEN (s.q <> '' AND s.q <> t.q) OR s.x <> t.x THEN 'update' ELSE 'skip' END AS action,
  CASE WHEN t.k IS NULL OR s.k IS NULL THEN '' ELSE array_to_string(list_filter([CASE WHEN s.q <> '' AND s.q <> t.q THEN 'q' END, CASE WHEN s.x <> t.x THEN 'x' END], lambda z: z IS NOT NULL), ',') END AS changed, false AS duplicate
FROM t FULL JOIN s ON t.k = s.k""")
def upsert_plan(t: Tables) -> DataFrame:
    target = t.labels.select(F.col("doc_id").cast("string").alias("k"), F.col("quality").cast("string").alias("q"), F.col("toxic").cast("string").alias("x"), F.col("doc_id").alias("pos"))
    seed = t.documents.where("doc_id % 3 <> 0").select(F.col("doc_id").cast("string").alias("k"), F.when(F.col("n_chars") > 600, "1").otherwise("").alias("q"), F.when(F.col("doc_id") % 4 == 0, "1").otherwise("0").alias("x"), F.col("doc_id").alias("pos"))
    return diff.upsert_plan(target, seed, ["k"], ["q", "x"])


_REQUESTS_SQL = """
r AS (SELECT event_id AS pos, CASE WHEN event_id % 11 = 0 THEN '' ELSE user_id || ':' || event_type || ':' || CAST(floor(value) AS BIGINT) END AS h, CASE WHEN event_type = 'error' THEN 'ambiguous' ELSE 'resolved' END AS st,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE 'rec' || user_id END AS rec, CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'f' END AS f, CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN '' ELSE 'new' || (event_id % 3) END AS v FROM events),
a AS (SELECT DISTINCT h FROM r WHERE h <> '' AND TRY_CAST(string_split(h, ':')[1] AS INT) % 2 = 0),
g AS (SELECT r.*, CASE WHEN h <> '' AND pos > min(CASE WHEN h <> '' THEN pos END) OVER (PARTITION BY h) THEN 'duplicate' WHEN h NOT IN (SELECT h FROM a) THEN 'not_approved'
  WHEN st <> 'resolved' OR rec = '' THEN 'not_resolved' WHEN f IS NULL THEN 'no_field' WHEN v = '' THEN 'no_value' END AS reason FROM r)"""


def _requests(t: Tables) -> tuple[DataFrame, DataFrame]:
    h = F.concat_ws(":", "user_id", "event_type", F.floor("value").cast("long"))
    r = t.events.select(
        F.col("event_id").alias("pos"), F.when(F.col("event_id") % 11 == 0, "").otherwise(h).alias("delta_hash"), F.when(F.col("event_type") == "error", "ambiguous").otherwise("resolved").alias("resolution_status"),
        F.when(F.col("event_id") % 7 == 0, "").otherwise(F.concat(F.lit("rec"), F.col("user_id"))).alias("record_id"), F.lit("t").alias("table"), F.when(F.col("event_id") % 13 != 0, "f").alias("field"),
        F.when(F.expr("event_type = 'view' and event_id % 2 = 0"), "").otherwise(F.concat(F.lit("new"), F.col("event_id") % 3)).alias("new_value"), F.lit("old").alias("old_value"), "user_id",
    )
    return r, r.where("user_id % 2 = 0").select("delta_hash").distinct()


@query(f"WITH {_REQUESTS_SQL} SELECT pos, CASE WHEN reason IS NULL THEN 'apply' ELSE 'skip' END AS action, reason FROM g")
def gate_stack(t: Tables) -> DataFrame:
    r, approved = _requests(t)
    return diff.gate_stack(r, approved).select("pos", "action", "reason")


@query(f"""
WITH {_REQUESTS_SQL}
SELECT pos, CASE WHEN u % 10 = 8 THEN 'error' WHEN u % 3 = 0 AND v = 'new1' THEN 'already_applied' WHEN u % 3 = 0 THEN 'drift_abstained' ELSE 'write' END AS status
FROM (SELECT *, TRY_CAST(string_split(h, ':')[1] AS INT) AS u FROM g WHERE reason IS NULL)""")
def guarded_writes(t: Tables) -> DataFrame:
    r, approved = _requests(t)
    live = t.events.where("user_id % 10 <> 8").select(F.lit("t").alias("table"), F.concat(F.lit("rec"), F.col("user_id")).alias("record_id"), F.lit("f").alias("field"), F.when(F.col("user_id") % 3 == 0, " new1").otherwise("old ").alias("current")).distinct()
    return diff.guarded_writes(diff.gate_stack(r, approved), live).select("pos", "status")


@query("""
SELECT user_id || ':' || event_type AS finding_hash, min(event_id) AS pos FROM events
WHERE user_id || ':' || event_type NOT IN (SELECT user_id || ':' || event_type FROM events WHERE value > 40) GROUP BY 1""")
def findings_upsert(t: Tables) -> DataFrame:
    f = t.events.select(F.concat_ws(":", "user_id", "event_type").alias("finding_hash"), F.col("event_id").alias("pos"), "value")
    return diff.fresh_findings(f, f.where("value > 40")).select("finding_hash", "pos")


@query("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT c_custkey, NULL, c_acctbal + 1 FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 7 = 0""")
def overlay_merge(t: Tables) -> DataFrame:
    base = t.customer.where("c_custkey % 7 <> 0").select("c_custkey", "c_name", "c_acctbal", F.col("c_custkey").alias("pos"))
    patch = t.customer.where("c_custkey % 10 = 0").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return diff.overlay(base, patch, "c_custkey", ["c_acctbal"]).drop("pos")


@query("""
SELECT coalesce(b.k, r.k) AS path, CASE WHEN r.k IS NOT NULL THEN r.v ELSE b.v END AS text, CASE WHEN r.k IS NOT NULL THEN 'review' ELSE 'bundle' END AS origin
FROM (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_partkey % 2 = 0) b FULL JOIN (SELECT p_partkey AS k, p_brand AS v FROM part WHERE p_partkey % 3 = 0) r ON b.k = r.k""")
def tree_overlay(t: Tables) -> DataFrame:
    pick = lambda n, v: t.part.where(f"p_partkey % {n} = 0").select(F.col("p_partkey").alias("path"), F.col(v).alias("text"))
    return diff.tree_overlay(pick(2, "p_name"), pick(3, "p_brand"))


@query("""
WITH w AS (SELECT conv_id, role, unnest(list_distinct(string_split(lower(text), ' '))) AS token FROM conversations),
g AS (SELECT conv_id, token, min(CASE role WHEN 'user' THEN 'a' ELSE 'b' END) AS lo, max(CASE role WHEN 'user' THEN 'a' ELSE 'b' END) AS hi FROM w WHERE role IN ('user', 'assistant') GROUP BY ALL)
SELECT conv_id, token, lo AS only_in FROM g WHERE lo = hi""")
def symmetric_difference(t: Tables) -> DataFrame:
    side = F.when(F.col("role") == "user", "a").when(F.col("role") == "assistant", "b")
    return diff.token_symmetric_difference(t.conversations, ["conv_id"], side, F.array_distinct(F.split(F.lower("text"), " ")))


@query("""
WITH o AS (SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS v FROM events),
n AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'j' ELSE 'k' END AS path, CASE WHEN event_id % 3 = 0 THEN '0' ELSE json_extract_string(props, '$.k') END AS v FROM events WHERE event_id % 4 <> 0)
SELECT CAST(coalesce(o.event_id, n.event_id) AS VARCHAR) AS key, CASE WHEN o.v IS NULL THEN 'add' WHEN n.v IS NULL THEN 'remove' ELSE 'replace' END AS op, '/' || coalesce(o.path, n.path) AS path, n.v AS value
FROM o FULL JOIN n ON o.event_id = n.event_id AND o.path = n.path WHERE o.v IS DISTINCT FROM n.v""")
def tree_diff(t: Tables) -> DataFrame:
    old = t.events.select("event_id", "props")
    key, value = F.when(F.col("event_id") % 5 == 0, "j").otherwise("k"), F.when(F.col("event_id") % 3 == 0, "0").otherwise(F.get_json_object("props", "$.k"))
    new = t.events.where("event_id % 4 <> 0").select("event_id", F.concat(F.lit('{"'), key, F.lit('": '), value, F.lit("}")).alias("props"))
    return diff.tree_diff(old, new, "event_id", "props")


@query("""
SELECT 'part' AS "table", f AS field, s AS state FROM (VALUES ('p_partkey', 'match'), ('p_title', 'match'), ('p_size', 'type'), ('p_kind', 'missing'), ('p_brand', 'extra')) v(f, s)""")
def schema_parity(t: Tables) -> DataFrame:
    a = t.rows([("part", "p_partkey", "long"), ("part", "p_name", "string"), ("part", "p_size", "int"), ("part", "p_kind", "string"), ("part", "p_temp", "int")], "table string, field string, type string")
    b = t.rows([("part", "p_partkey", "long"), ("part", "p_title", "string"), ("part", "p_size", "long"), ("part", "p_brand", "string")], "table string, field string, type string")
    return diff.schema_parity(a, b, {"p_name": "p_title"}, ["p_temp"])


@query("""
WITH a AS (SELECT p_brand, p_name FROM part), b AS (SELECT CASE WHEN p_size = 1 THEN 'Brand#new' ELSE p_brand END AS p_brand, p_name FROM part),
m AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a), i AS (SELECT 'Brand#new' AS p_brand, p_name FROM part WHERE p_size = 1 AND p_partkey % 2 = 0)
SELECT *, 'unintended' AS gate FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM i) UNION ALL SELECT *, 'lost' FROM (SELECT * FROM i EXCEPT ALL SELECT * FROM m)""")
def rebuild_gate(t: Tables) -> DataFrame:
    before = t.part.select("p_brand", "p_name")
    after = t.part.select(F.when(F.col("p_size") == 1, "Brand#new").otherwise(F.col("p_brand")).alias("p_brand"), "p_name")
    return diff.only_intended(before, after, t.part.where("p_size = 1 and p_partkey % 2 = 0").select(F.lit("Brand#new").alias("p_brand"), "p_name"))


@query()
def block_diff(t: Tables) -> DataFrame:
    """Sequence diff of each conversation with the next one, turn by turn."""
    c = t.conversations.select(F.floor(F.col("conv_id") / 2).alias("pair"), (F.col("conv_id") % 2).alias("side"), "turn", "text")
    return diff.block_diff(c.where("side = 0"), c.where("side = 1"), "pair", "text", "turn")


@query()
def partial_ratios(t: Tables) -> DataFrame:
    """How close neighbouring turns are."""
    c = t.conversations.select("conv_id", "turn", F.col("text").alias("a"))
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    return c.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(partial_ratio("a", "b"), 6).alias("ratio"))


@query()
def nfkc_norm(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(search_form(F.coalesce("text", F.lit("")))).alias("norm"))
