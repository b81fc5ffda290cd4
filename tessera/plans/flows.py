"""Sources, snapshots, ledgers, the queue's results and event streams on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import diff, lookup, quality, queue
from tessera.plans.registry import Tables, query
from tessera.sources import files, schema, snapshots
from tessera.streaming import events as streams


def _n() -> Column:
    return F.col("p_size")


def _key(c: str = "p_partkey") -> Column:
    return F.col(c).cast("string")


def _text(*parts: Column | str) -> Column:
    """Columns, and texts as they stand, in one text."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ', \"' || p_brand || '\"' || CASE WHEN p_size % 2 = 0 THEN chr(10) || 'x' ELSE '' END AS text FROM part UNION ALL SELECT 'absent', NULL WHERE false")
def csv_roundtrip(t: Tables) -> DataFrame:
    """part as CSV with quotes, commas and line breaks in cells, read again by schema, with a table that is not there."""
    out = t.folder()
    rows = t.part.select(_key().alias("id"), _text(F.col("p_name"), ', "', F.col("p_brand"), '"', F.when(_n() % 2 == 0, "\nx").otherwise("")).alias("text"))
    rows.write.option("header", True).option("escape", '"').csv(f"{out}/parts")
    return files.read_csv(t.spark, f"{out}/parts", rows.schema).unionByName(files.read_csv(t.spark, f"{out}/absent", rows.schema))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part WHERE p_size % 3 = 0")
def overflow_cells(t: Tables) -> DataFrame:
    """The rows of CSV files, a thousand rows each, that have more cells than columns."""
    from pyspark.sql import types as T

    out = t.folder()
    line = _text(_key(), ",", F.col("p_name"), F.when(_n() % 3 == 0, ",one too many").otherwise(""))
    sheets = t.part.groupBy(F.floor(F.col("p_partkey") / 1000).alias("k")).agg(_text("id,name\n", F.array_join(F.collect_list(line), "\n")).alias("sheet"))
    sheets.write.partitionBy("k").text(out)
    named = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    return files.read_csv(t.spark, f"{out}/*", named, corrupt="raw").where("raw is not null").select("id", "name")


@query("""
SELECT hash, min_by(side, side) AS side FROM (SELECT 'h' || p_size AS hash, 'a' AS side FROM part WHERE p_size < 20 UNION ALL SELECT 'h' || p_size, 'b' FROM part WHERE p_size >= 10) GROUP BY hash""")
def ledger_union(t: Tables) -> DataFrame:
    """Two ledgers of JSON lines, one with lines that are no JSON, and one that is not there: the first of each hash."""
    out = t.folder()
    line = lambda side: _text('{"hash": "h', _n().cast("string"), f'", "side": "{side}"}}')
    t.part.where("p_size < 20").select(line("a")).unionByName(t.region.select(F.lit("no json").alias("line")).toDF(t.part.select(line("a")).columns[0])).write.text(f"{out}/a")
    t.part.where("p_size >= 10").select(line("b")).write.text(f"{out}/b")
    return files.read_ledger(t.spark, [f"{out}/a", f"{out}/none", f"{out}/b"], "hash string, side string", "hash")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def report_findings(t: Tables) -> DataFrame:
    """Report files of both shapes, a file a nation."""
    out = t.folder()
    one = _text('{"code": "', _key("n_nationkey"), '", "name": "', F.col("n_name"), '"}')
    shaped = F.when(F.col("n_nationkey") % 2 == 0, _text("[", one, "]")).otherwise(_text('{"findings": [', one, "]}"))
    t.nation.select(shaped, F.col("n_nationkey").alias("k")).write.partitionBy("k").text(out)
    return files.read_report(t.spark, f"{out}/*", "code string, name string").select("code", "name")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS path, CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'D' ELSE 'M' END AS status, CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END AS added, CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS removed FROM part WHERE p_size % 6 <> 5""")
def tree_changes(t: Tables) -> DataFrame:
    old = t.part.where("p_size % 3 <> 0").select(_key().alias("path"), _text("a\n", F.col("p_name")).alias("text"))
    new = t.part.where("p_size % 3 <> 1").select(_key().alias("path"), _text("a\n", F.when(_n() % 6 == 5, F.col("p_name")).otherwise(F.upper("p_name"))).alias("text"))
    return files.tree_changes(old, new)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS path, CASE WHEN p_size % 4 = 0 THEN 'missing' WHEN p_size % 4 = 1 THEN 'added' ELSE 'changed' END AS state FROM part WHERE p_size % 4 < 3""")
def frozen_files(t: Tables) -> DataFrame:
    """A release's files against its frozen inventory."""
    named = lambda where, sha: t.part.where(where).select(_key().alias("path"), F.sha2(sha, 256).alias("sha256"))
    return diff.verified(named("p_size % 4 <> 0", F.when(_n() % 4 == 2, F.col("p_brand")).otherwise(F.col("p_name"))), named("p_size % 4 <> 1", F.col("p_name")))


@query("SELECT 'r' || p_partkey AS record_id, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def decoded_records(t: Tables) -> DataFrame:
    """Both shapes of an envelope of table records."""
    name, size, record = _text('"', F.col("p_name"), '"'), _n().cast("string"), _text('"r', _key(), '"')
    listed = _text('{"records": [{"record_id": ', record, ', "fields": {"name": ', name, ', "size": ', size, "}}]}")
    columnar = _text('{"fields": ["name", "size"], "record_id_list": [', record, '], "data": [[', name, ", ", size, "]]}")
    found = files.decode_records(t.part.select(F.when(_n() % 2 == 0, columnar).otherwise(listed).alias("e")), "e")
    return found.select("record_id", F.col("fields")["name"].alias("name"), F.col("fields")["size"].alias("size"))


@query("""
SELECT unnest(['variable_defaults', 'variable_defaults', 'variable_defaults', 'variable_lang_overrides', 'variable_lang_overrides']) AS tb, unnest(['Model_key', 'is_default', 'Extra', 'from_prefix', 'to_prefix']) AS col,
  unnest(['missing', 'missing', 'extra', 'missing', 'missing']) AS state, unnest([false, true, false, false, false]) AS required""")
def schema_drift(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_name").alias("Variable_key"), F.col("p_brand").alias("Model"), F.col("p_size").alias("Value"), F.col("p_type").alias("Extra"))
    other = t.part.select(*[F.lit("").alias(c) for c in ("Variable_key", "lang", "source_value", "Value")])
    found = schema.drift_report(t.spark, {"variable_defaults": part, "variable_lang_overrides": other})
    return found.where("state <> 'missing_table'").select(F.col("table").alias("tb"), F.col("column").alias("col"), "state", "required")


@query("SELECT 'lang' AS col, count(*) AS n FROM part UNION ALL SELECT 'Variable_key', count(*) FILTER (p_size % 3 = 0) FROM part")
def source_contract(t: Tables) -> DataFrame:
    rows = t.part.select(F.when(_n() % 3 == 0, " ").otherwise(F.col("p_name")).alias("Variable_key"))
    return schema.contract_issues(rows, schema.TABLES["variable_lang_overrides"]).select(F.col("column").alias("col"), "n")


@query("""
SELECT 'nation' AS tb, 'ok' AS state, (SELECT count(*) FROM nation) AS row_count, false AS changed UNION ALL SELECT 'part', 'ok', (SELECT count(*) FROM part WHERE p_size > 5), true UNION ALL SELECT 'supplier', 'missing', NULL, NULL""")
def snapshot_published(t: Tables) -> DataFrame:
    """Two snapshots, the second with one table changed: the manifest and the state of the one that is current."""
    root = t.folder()
    snapshots.publish(t.spark, {"nation": t.nation, "part": t.part}, root)
    snapshots.publish(t.spark, {"nation": t.nation.repartition(3), "part": t.part.where("p_size > 5")}, root)
    now = snapshots.current(t.spark, root)
    rows = t.spark.read.parquet(f"{now}/_manifest").select(F.col("table").alias("tb"), "row_count", "changed")
    return snapshots.inspect(t.spark, now, ["nation", "part", "supplier"]).withColumnRenamed("table", "tb").join(rows, "tb", "left")


@query("SELECT p_partkey, p_name FROM part WHERE p_size <= 30")
def ledger_append(t: Tables) -> DataFrame:
    """A ledger that takes overlapping runs, one of them twice, and holds each key once."""
    path = t.folder()
    for where in ("p_size < 20", "p_size between 10 and 30", "p_size between 10 and 30"):
        snapshots.append_new(t.part.where(where).select("p_partkey", "p_name"), path, "p_partkey")
    return t.spark.read.parquet(path)


@query("SELECT 'b' AS side, p_partkey FROM part WHERE p_size = 1 UNION ALL SELECT 'a', p_partkey FROM part WHERE p_size = 2")
def restored_backup(t: Tables) -> DataFrame:
    """A backup against the table as it was since changed."""
    path = t.folder()
    snapshots.backup(t.part.where("p_size <> 1"), path)
    return snapshots.differences(snapshots.restore(t.spark, path), t.part.where("p_size <> 2")).select("side", "p_partkey")


@query("""
SELECT p_partkey, sha1('{"changes":["1","' || p_name || '"],"meta":{"run":"' || p_size || '"}}') AS run_key FROM part""")
def run_keys(t: Tables) -> DataFrame:
    report = _text('{"changes": ["1", "', F.col("p_name"), '", "past the first two"], "run": ', _n().cast("string"), "}")
    return t.part.select("p_partkey", quality.run_key(report, 2).alias("run_key"))


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name || ' new' WHEN 1 THEN p_brand END AS value FROM part""")
def written_values(t: Tables) -> DataFrame:
    """Whole texts, one changed cell, two changed cells, and a cell that stands nowhere."""
    old_cells, both = F.array(F.col("p_name"), F.col("p_name")), F.array(F.col("p_brand"), F.col("p_type"))
    new_cells = F.when(_n() % 4 == 1, F.array(F.col("p_name"), F.col("p_brand"))).otherwise(both)
    old = F.when(_n() % 4 == 0, F.col("p_name")).otherwise("row")
    value = diff.written_value(old, _text(F.col("p_name"), "  new"), F.when(_n() % 4 == 3, "elsewhere").otherwise(F.col("p_name")), old_cells, new_cells)
    return t.part.select("p_partkey", value.alias("value"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 1 THEN 'translation_memory' ELSE 'source_table' END AS target FROM part")
def routed_edits(t: Tables) -> DataFrame:
    return diff.routed_edits(t.part.select("p_partkey", F.when(_n() % 3 == 0, " EN").when(_n() % 3 == 1, "fr").alias("lang"), F.lit("en").alias("source_lang"))).select("p_partkey", "target")


@query("""
WITH m AS (SELECT p_name AS norm, p_partkey FROM part), u AS (SELECT norm, min(p_partkey) AS lo, max(p_partkey) AS hi FROM m GROUP BY 1)
SELECT o_orderkey AS delta_hash, CASE WHEN a.lo = a.hi THEN a.lo WHEN a.lo IS NULL AND b.lo = b.hi THEN b.lo END AS record_id,
  CASE WHEN a.lo = a.hi THEN 'write' WHEN a.lo IS NOT NULL THEN 'ambiguous' WHEN b.lo IS NOT NULL THEN 'already' ELSE 'missing' END AS status
FROM orders JOIN part p ON p.p_partkey = o_orderkey % 2000 LEFT JOIN u a ON a.norm = CASE o_orderkey % 3 WHEN 0 THEN p.p_name ELSE 'none' END LEFT JOIN u b ON b.norm = CASE o_orderkey % 3 WHEN 1 THEN p.p_name ELSE 'nothing' END""")
def memory_writes(t: Tables) -> DataFrame:
    n = F.col("o_orderkey") % 3
    asked = t.orders.select("o_orderkey", (F.col("o_orderkey") % 2000).alias("p_partkey")).join(t.part, "p_partkey")
    edits = asked.select(F.col("o_orderkey").alias("delta_hash"), F.lit("fr").alias("lang"), F.when(n == 0, _text(" ", F.col("p_name"))).otherwise("none").alias("old_text"), F.when(n == 1, F.col("p_name")).otherwise("nothing").alias("new_text"))
    return lookup.memory_writes(edits, t.part.select(F.col("p_partkey").alias("record_id"), F.lit("fr").alias("lang"), F.col("p_name").alias("text")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'n' || (o_orderkey % 25) || CASE WHEN o_orderkey % 4 = 1 AND o_orderkey % 25 <> 3 THEN ',n3' ELSE '' END END AS ids, CASE WHEN o_orderkey % 4 = 2 THEN 'gone' ELSE '' END AS unresolved FROM orders""")
def refs_to_ids(t: Tables) -> DataFrame:
    n = F.col("o_orderkey")
    refs = F.when(n % 4 == 0, " ").otherwise(_text("r", (n % 25).cast("string"), F.when(n % 4 == 1, ", r3").when(n % 4 == 2, ",gone").otherwise("")))
    known = t.nation.select(_text("r", _key("n_nationkey")).alias("record_id"), _text("n", _key("n_nationkey")).alias("business_id"))
    return lookup.refs_to_ids(t.orders.select("o_orderkey", refs.alias("refs")), "o_orderkey", "refs", known)


@query("""
WITH s AS (SELECT o_custkey, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey AS k, CASE WHEN lo = hi THEN lo END AS o_orderkey, CASE WHEN lo = hi THEN 'copy' ELSE 'needs_input' END AS status FROM customer LEFT JOIN s ON o_custkey = c_custkey""")
def seed_plan(t: Tables) -> DataFrame:
    return lookup.seed_plan(t.customer.select(F.col("c_custkey").alias("k")), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"), "o_orderkey"), "k", "o_orderkey")


@query("SELECT o_orderkey AS document_key, unnest(['wifi', 'power']) AS page FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, 'power' FROM orders WHERE o_orderstatus = 'F'")
def allowed_pages(t: Tables) -> DataFrame:
    pages = t.orders.select(F.col("o_orderkey").alias("document_key"), F.explode(F.array(F.lit("wifi"), F.lit("power"))).alias("page"))
    has = t.orders.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("document_key"), F.lit("radio").alias("capability"), (F.col("o_orderstatus") == "P").alias("has"))
    return lookup.allowed_pages(pages, has, t.rows([("radio", "wifi", True), ("radio", "power", False)], "capability string, page string, forbidden boolean"))


@query("""
WITH l AS (SELECT p_partkey AS delta_hash, p_size % 5 AS k, p_size FROM part)
SELECT delta_hash, CASE k WHEN 0 THEN 'rejected' WHEN 1 THEN CASE p_size % 3 WHEN 0 THEN 'accepted_as_proposed' WHEN 1 THEN 'rejected' ELSE 'pending' END WHEN 2 THEN 'accepted_as_proposed' WHEN 3 THEN 'rejected' ELSE 'pending' END AS final_status FROM l""")
def reconciled_ledger(t: Tables) -> DataFrame:
    """Decided rows stay, table suggestions follow their write, review texts what the source holds."""
    k, mine, theirs = _n() % 5, _text("machine ", F.col("p_name")), _text("reviewer ", F.col("p_brand"), " ", F.col("p_name"))
    ledger = t.part.select(
        F.col("p_partkey").alias("delta_hash"), F.when(k == 1, "source_table_suggestion").when(k == 0, "image").otherwise("repo_review_text").alias("route_class"), F.when(k == 0, "rejected").when(k == 1, " ").otherwise("pending").alias("final_status"),
        mine.alias("machine_text"), theirs.alias("reviewer_text"), F.col("p_partkey").alias("source_path"),
    )
    outcomes = t.part.where("p_size % 3 < 2").select(F.col("p_partkey").alias("delta_hash"), F.when(_n() % 3 == 0, "written").otherwise("drifted").alias("status"))
    sources = t.part.where("p_size % 5 <> 4").select(F.col("p_partkey").alias("source_path"), F.when(k == 2, _text("intro ", theirs)).otherwise(_text("intro ", mine)).alias("haystack"))
    return quality.reconciled(ledger, outcomes, sources).select("delta_hash", "final_status")


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'mine' WHEN p_size % 4 = 3 THEN 'new' ELSE p_name END AS v, CASE WHEN p_size % 4 IN (0, 3) THEN 'review' ELSE 'source' END AS origin FROM part WHERE NOT (p_size % 4 = 1 AND p_size > 25)""")
def merged_parameters(t: Tables) -> DataFrame:
    """Edited by the reviewer, dropped by the source, unchanged, and only with the reviewer."""
    k = _n() % 4
    side = lambda df, v: df.select("p_partkey", v.alias("v"))
    base, source = t.part.where(k != 3), t.part.where((k != 3) & ~((k == 1) & (_n() > 25)))
    review = F.when(k == 0, "mine").when(k == 3, "new").otherwise(F.lower("p_type"))
    return diff.merged_edits(side(base, F.lower("p_type")), side(source, F.col("p_name")), side(t.part, review), "p_partkey", "v")


@query("""
SELECT 'unfilled_placeholder' AS rule, CAST(p_partkey AS VARCHAR) AS ref, 'model' AS name FROM part WHERE p_size % 3 = 0 UNION ALL SELECT 'missing_file', CAST(p_partkey AS VARCHAR), 'img/' || p_size || '.png' FROM part WHERE p_size > 10""")
def bundle_issues(t: Tables) -> DataFrame:
    page = _text(".. image:: img/", _n().cast("string"), ".png\n", F.when(_n() % 3 == 0, "{{model}} {{model}}").otherwise("{ {x} }"))
    found = quality.bundle_issues(t.part.select(_key().alias("path"), page.alias("text")), t.part.where("p_size <= 10").select(_text("img/", _n().cast("string"), ".png").alias("path")).distinct())
    return found.select("rule", "ref", F.get_json_object("evidence", "$.name").alias("name"))


@query("SELECT DISTINCT p_brand || '.txt' AS snippet, p_type AS file FROM part UNION SELECT 's' || p_size, p_type FROM part")
def snippet_uses(t: Tables) -> DataFrame:
    page = _text("{{ snippet:s", _n().cast("string"), " }}\n.. include:: ", F.col("p_brand"), ".txt\n{{other}}")
    return quality.snippet_uses(t.part.select("p_type", page.alias("text")), "p_type", "text")


@query("""
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'html' WHEN 2 THEN 'cloud_doc' ELSE 'none' END AS kind, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END AS url, p_size % 4 <> 3 AND p_size % 5 <> 0 AND p_size > 20 AS ready,
  p_size % 4 = 2 AND p_size < 10 AS baseline_missing FROM part""")
def deliveries(t: Tables) -> DataFrame:
    action = F.when(_n() % 4 == 0, "Publish").when(_n() % 4 == 1, "web_publish ").when(_n() % 4 == 2, "draft").otherwise("check")
    made = queue.delivery(action, F.when(_n() % 5 == 0, " ").otherwise(F.col("p_name")), F.when(_n() > 20, "SUCCESS | x=1").when(_n() > 15, "FAILED"), F.when(_n() >= 10, F.lit(True)))
    return t.part.select("p_partkey", made.alias("d")).select("p_partkey", "d.*")


@query("SELECT p_partkey, p_size % 3 = 0 AS safe FROM part")
def parameter_only(t: Tables) -> DataFrame:
    old = _text("Title\n  :width: ", F.col("p_name"), "\n:alt: x\ntext")
    new = F.when(_n() % 3 == 0, _text("Title\n  :width: ", F.col("p_brand"), "\n:alt: x\ntext")).when(_n() % 3 == 1, _text("Title\n  :height: ", F.col("p_name"), "\n:alt: x\ntext")).otherwise(old)
    return t.part.select("p_partkey", quality.parameter_only(old, new).alias("safe"))


@query("""
SELECT event_id, user_id % 3 = 0 AND event_type <> 'error' AND event_id % 5 < 3 AS build FROM events WHERE event_id % 7 <> 0""")
def build_requests(t: Tables) -> DataFrame:
    """Event lines, some of them no JSON, and whether each asks for a build: an edit that sets the flag."""
    n = F.col("event_id")
    action = F.when(F.col("event_type") == "error", "record_deleted").when(n % 2 == 0, "record_added").otherwise("record_edited")
    value = F.when(n % 5 == 0, "true").when(n % 5 == 1, "1").when(n % 5 == 2, "[true]").when(n % 5 == 3, "0").otherwise("false")
    line = _text(
        '{"header": {"event_id": "', _key("event_id"), '", "event_type": "changed"}, "event": {"file_token": "f', (F.col("user_id") % 3).cast("string"), '", "file_type": "table", "table_id": "t", "action_list": [{"action": "', action,
        '", "after_value": [{"field_id": "a", "field_value": "true"}, {"field_id": "now", "field_value": "', value, '"}]}]}}',
    )
    read = streams.parsed(t.events.select(F.when(n % 7 == 0, _text("no JSON ", _key("event_id"))).otherwise(line).alias("value")))
    return read.select(F.col("header.event_id").cast("long").alias("event_id"), streams.asks_for_build("changed", "table", "f0", "t", "now").alias("build"))


@query("""
SELECT c_custkey AS record_id, unnest(['a', 'b']) AS token, unnest([c_nationkey % 3 <> 0, false]) AS granted, unnest([CASE WHEN c_nationkey % 3 <> 0 THEN 'RUNNING | claim_token=a | claim_expires_at=2024-01-01T02:00:00Z' END, NULL]) AS result FROM customer""")
def claimed_records(t: Tables) -> DataFrame:
    """Two askers for each record; a third of the records are held by a live lease, a third by one that has ended."""
    n, now = F.col("c_nationkey") % 3, F.lit("2024-01-01 00:00:00").cast("timestamp")
    held = F.when(n == 0, "RUNNING | claim_token=x | claim_expires_at=2024-01-01T00:00:01Z").when(n == 1, "RUNNING | claim_token=x | claim_expires_at=2024-01-01T00:00:00Z").otherwise("")
    asked = t.customer.select(F.col("c_custkey").alias("record_id"), F.explode(F.array(F.lit("b"), F.lit("a"))).alias("token"))
    return queue.claimed(t.customer.select(F.col("c_custkey").alias("record_id"), held.alias("result")), asked, now).select("record_id", "token", "granted", "result")


def _stream(t: Tables, rows: DataFrame, per_batch: int = 1000) -> tuple[DataFrame, str]:
    """rows written as files and read as a stream of these, so many in a batch, with a folder for what comes of it."""
    out = t.folder()
    rows.write.parquet(f"{out}/in")
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{out}/in"), out


def _streamed(made: DataFrame, out: str) -> DataFrame:
    """All that a stream appends, as files read back."""
    made.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return made.sparkSession.read.schema(made.schema).parquet(f"{out}/rows")


@query("SELECT user_id AS record_id, event_id, rank() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS granted FROM events WHERE ts < TIMESTAMP '2024-01-01 02:00:00'")
def stream_leases(t: Tables) -> DataFrame:
    """Requests of the first two hours as a stream: each user's first asker holds the lease of two hours all that time."""
    asked = t.events.where("ts < timestamp_ntz'2024-01-01 02:00:00'").select(_key("user_id").alias("record_id"), _key("event_id").alias("token"), F.col("ts").cast("timestamp").alias("at"))
    stream, out = _stream(t, asked)
    return _streamed(streams.leases(stream), out).select(F.col("record_id").cast("long").alias("record_id"), F.col("token").cast("long").alias("event_id"), "granted")


@query("""
SELECT user_id AS conversation, string_agg(event_type, '/' ORDER BY ts, event_id) AS said FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back <= 3 GROUP BY 1""")
def stream_contexts(t: Tables) -> DataFrame:
    """The last three messages of every conversation, from a stream of all."""
    said = t.events.select(_key("user_id").alias("conversation"), F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("text"))
    stream, out = _stream(t, said)
    return _streamed(streams.contexts(stream, keep=3), out).groupBy(F.col("conversation").cast("long").alias("conversation")).agg(F.translate(F.max_by("events", "at"), "\n", "/").alias("said"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def batch_trigger(t: Tables) -> DataFrame:
    """A build for each micro-batch that has rows: each appends its counts, which add up to the table's."""
    stream, out = _stream(t, t.events.select("event_id", "event_type").repartition(3), 1)
    streams.on_batch(stream, lambda batch, number: batch.groupBy("event_type").agg(F.count("*").alias("n")).write.mode("append").parquet(f"{out}/rows"), f"{out}/state", once=True).awaitTermination()
    return t.spark.read.schema("event_type string, n long").parquet(f"{out}/rows").groupBy("event_type").agg(F.sum("n").alias("n"))
