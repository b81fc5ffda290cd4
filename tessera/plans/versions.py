"""Versions of texts, rules by target, searches of many questions and keyed state over streams, on the supplied tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import values
from tessera.operators import align, checks, lineage, postings, quality, records
from tessera.plans.registry import Tables, query
from tessera.sources import files
from tessera.streaming import claims


def _lines(*parts) -> F.Column:  # noqa: ANN002
    """A text of lines, each ended by a line feed; null parts are no line."""
    return F.concat(*[F.coalesce(F.concat(p if not isinstance(p, str) else F.lit(p), F.lit("\n")), F.lit("")) for p in parts])


def _side(t: Tables, *parts) -> DataFrame:  # noqa: ANN002
    return t.part.select(F.col("p_partkey").cast("string").alias("k"), _lines(*parts).alias("t"))


@query("""
WITH l AS (
  SELECT p_partkey, p_size % 4 AS c, unnest(CASE p_size % 4
    WHEN 0 THEN [['head', 'base'], [p_type, 'ours'], ['mid', 'base'], [p_brand, 'base'], ['tail', 'base'], ['more', 'theirs']]
    WHEN 1 THEN [['head', 'base'], [p_name || '!', 'conflict_ours'], [p_name || '?', 'conflict_theirs'], ['mid', 'base'], [p_brand, 'base'], ['tail', 'base']]
    WHEN 2 THEN [['head', 'base'], [p_name, 'base'], [p_brand, 'base'], ['tail', 'base']]
    ELSE [['head', 'base'], ['same', 'both'], ['mid', 'base'], [p_brand, 'base'], ['tail', 'base']] END) AS x FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS key, x[1] AS line, x[2] AS origin, count(*) AS n FROM l GROUP BY 1, 2, 3""")
def merged_texts(t: Tables) -> DataFrame:
    """Three-way merges of a text a part: far edits, a conflict, a line that one side deleted, and the same edit on both sides."""
    c, name = F.col("p_size") % 4, F.col("p_name")
    base = _side(t, "head", name, "mid", F.col("p_brand"), "tail")
    ours = _side(t, "head", F.when(c == 0, F.col("p_type")).when(c == 1, F.concat(name, F.lit("!"))).when(c == 3, "same").otherwise(name), "mid", F.col("p_brand"), "tail")
    theirs = _side(t, "head", F.when(c == 1, F.concat(name, F.lit("?"))).when(c == 3, "same").otherwise(name), F.when(c != 2, "mid"), F.col("p_brand"), "tail", F.when(c == 0, "more"))
    return align.merged3(base, ours, theirs, "k", "t").groupBy("key", "line", "origin").agg(F.count("*").alias("n"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS key, 'Title' || CASE WHEN p_size % 3 = 1 THEN ', edited' ELSE '' END || chr(10) || CASE p_size % 3 WHEN 2 THEN 'Its name is ' || p_brand WHEN 1 THEN 'Name: ' || p_brand ELSE 'Name: ' || p_name END || chr(10) ||
  CASE WHEN p_size % 3 = 1 THEN 'A note' || chr(10) ELSE '' END || 'Size ' || p_size || ' of ' || p_type || chr(10) || 'End' || chr(10) AS text FROM part""")
def refreshed_pages(t: Tables) -> DataFrame:
    """Reviewed pages with the slots of their template filled from a new build: titles edited, notes added (the name's line then stands
    as far along as the note, which does not fit it), a slot's line rewritten."""
    c, size = F.col("p_size") % 3, F.col("p_size").cast("string")
    template = _side(t, "Title", "Name: |NAME|", "Size |SIZE| of |TYPE|", "End")
    built = _side(t, "Title", F.concat(F.lit("Name: "), "p_name"), F.concat(F.lit("Size "), size, F.lit(" of "), F.col("p_type")), "End")
    review = _side(
        t, F.when(c == 1, "Title, edited").otherwise("Title"), F.when(c == 2, F.concat(F.lit("Its name is "), "p_brand")).otherwise(F.concat(F.lit("Name: "), "p_brand")),
        F.when(c == 1, "A note"), F.lit("Size 0 of old"), "End",
    )
    return align.refreshed(template, built, review, "k", "t")


@query()
def line_changes(t: Tables) -> DataFrame:
    """Lines that a minimal script adds and removes from each document to the one of the next id."""
    d = t.documents.select("doc_id", "text")
    after = d.select((F.col("doc_id") - 1).alias("doc_id"), "text")
    return align.line_counts(d.join(after.select("doc_id"), "doc_id", "left_semi"), after.join(d.select("doc_id"), "doc_id", "left_semi"), "doc_id", "text")


@query("""
SELECT p_brand AS target, code, severity, count(*) AS n, CASE WHEN max(severity = 'FAIL') OVER (PARTITION BY p_brand) THEN 'FAIL' ELSE 'WARN' END AS status FROM (
  SELECT p_brand, unnest(list_filter([
    CASE WHEN p_size % 7 = 0 THEN ['missing_source_lang', 'FAIL'] END, CASE WHEN p_size % 7 = 1 THEN ['invalid_source_lang', 'FAIL'] END, CASE WHEN p_size % 5 = 0 THEN ['missing_document_key', 'FAIL'] END,
    CASE WHEN p_size % 5 = 1 THEN ['invalid_document_key', 'FAIL'] END, CASE WHEN p_size % 3 = 0 THEN ['missing_source_row_label', 'FAIL'] END, CASE WHEN p_size % 4 = 0 THEN ['missing_source_value', 'FAIL'] END], lambda x: x IS NOT NULL)) AS x,
    x[1] AS code, x[2] AS severity FROM part WHERE p_size % 2 = 0 AND p_size <> 10)
GROUP BY p_brand, code, severity""")
def target_checks(t: Tables) -> DataFrame:
    """The specification rules over the latest rows of each brand as a target, in one scan, counted by target."""
    n, on = F.col("p_size"), lambda k, r, v: F.when(F.col("p_size") % k == r, v)
    rows = t.part.select(
        F.col("p_partkey").alias("line"), F.when(n % 5 == 0, "").when(n % 5 == 1, F.lit("Other_US")).when(n % 5 == 2, F.concat("p_brand", F.lit("_US"))).otherwise(F.concat("p_brand", F.lit("_US_"), on(7, 0, "").when(n % 7 == 1, "xx").otherwise("en"))).alias("document_key"),
        F.col("p_brand").alias("Model"), F.lit("US").alias("Region"), F.when(n % 7 == 0, " ").when(n % 7 == 1, "xx").otherwise("en").alias("Source_lang"), F.when(n % 2 == 0, "TRUE").otherwise("FALSE").alias("Is_Latest"),
        F.when(n == 10, "").otherwise("key").alias("Row_key"), F.when(n % 3 == 0, "").otherwise(F.col("p_name")).alias("Row_label_source"), F.when(n % 4 == 0, None).otherwise("1 W").alias("Value_source"),
    )
    rows = rows.withColumn("document_key", F.rtrim(F.regexp_replace("document_key", "_$", "")))
    targets = t.part.select(F.col("p_brand").alias("target"), F.col("p_brand").alias("model"), F.lit("US").alias("region")).distinct()
    found, _ = checks.checked(checks.rows_of_targets(rows, targets), checks.specification_rules(), ["target"], "line")
    return checks.report(found, ["target"]).drop("first_ref")


@query("""
WITH r AS (SELECT p_partkey, p_size AS n, p_partkey % 2 = 0 AS us, p_size % 10 AS op FROM part)
SELECT p_partkey, CASE op WHEN 0 THEN NULL WHEN 1 THEN 'spare' WHEN 2 THEN 'as  is'[1:3] || 'is' WHEN 3 THEN n || ' Wh (' || n || ' Ah / 12 V DC)'
  WHEN 4 THEN CASE WHEN us THEN 'About ' || CAST(round(n * 2.20462, 2) AS DOUBLE) || ' lbs/' || n || ' kg' ELSE 'About ' || n || ' kg' END
  WHEN 5 THEN CASE WHEN us THEN '1.0 × 10.0 × 1.0 in / ' ELSE '' END || '2.5 × 25.4 × 2.5 cm' WHEN 6 THEN CASE WHEN us THEN '-4 °F to 113 °F / ' ELSE '' END || '-20 °C to 45 °C'
  WHEN 7 THEN n || '.5 V⎓3 A max.' WHEN 8 THEN n || '00 cycles to 70%+ capacity' ELSE 'spare' END AS value,
  CASE op WHEN 0 THEN 'excluded' WHEN 1 THEN 'direct' WHEN 2 THEN 'direct' WHEN 6 THEN 'needs_review' WHEN 9 THEN 'direct' ELSE 'transformed' END AS status FROM r""")
def unit_transforms_all(t: Tables) -> DataFrame:
    """Every named transform in both regions, and a blank value with a default."""
    n, k = F.col("p_size").cast("string"), F.col("p_size") % 10
    op = F.element_at(F.array(*map(F.lit, ("exclude", "default", "passthrough", "capacity", "weight", "dims_mm_to_cm", "temp", "dc12", "cycle_life", "weight"))), (k + 1).cast("int"))
    raw = (
        F.when(k == 2, F.lit(" as  is ")).when(k == 3, F.concat(n, F.lit(" Wh 12 V "), n, F.lit(" Ah"))).when(k == 4, F.concat(n, F.lit(" Kg"))).when(k == 5, F.lit("25 mm x 254 mm x 25 mm"))
        .when(k == 6, F.lit("-20 ~ 45℃")).when(k == 7, F.concat(n, F.lit(".5V = 3A"))).when(k == 8, F.concat(n, F.lit("00 cycles"))).when(k == 9, F.lit(" ")).otherwise(F.lit("anything"))
    )
    made = values.converted(op, raw, F.lit("spare"), F.when(F.col("p_partkey") % 2 == 0, "us").otherwise("EU"))
    return t.part.select("p_partkey", made["value"].alias("value"), made["status"].alias("status"))


@query("""
WITH q AS (SELECT DISTINCT string_split(p_name, ' ')[1] || ' ' || (p_size % 30) AS text, p_type AS kind FROM part),
m AS (SELECT p_partkey AS key, p_type AS kind, list_concat([replace(lower(p_brand), '#', ' ')], string_split(p_name, ' ')) AS p, p_name AS t FROM part),
s AS (
  SELECT text, q.kind, key, list_sum(list_transform(string_split(text, ' '), lambda w:
    list_sum(list_transform(p, lambda v: CASE WHEN v = w THEN 90 WHEN contains(v, w) OR contains(w, v) THEN 60 ELSE 0 END))
    + CASE WHEN t = w THEN 60 WHEN contains(t, w) THEN 30 WHEN length(t) >= 4 AND contains(text, t) THEN 30 ELSE 0 END
    + CASE WHEN contains(array_to_string(list_append(p, t), ' '), w) THEN 10 ELSE 0 END)) AS score FROM q JOIN m USING (kind))
SELECT text, kind, key, score::INTEGER AS score, row_number() OVER (PARTITION BY text, kind ORDER BY score DESC, key)::INTEGER AS rank FROM s WHERE score > 0 QUALIFY rank <= 5""")
def many_searches(t: Tables) -> DataFrame:
    """The five best manuals of each of many questions with a facet, by postings, in one job."""
    rows = t.part.select("p_partkey", "p_brand", F.split("p_name", " ").alias("models"), "p_name", F.array("p_type").alias("kind"))
    out = t.folder()
    postings.merged(postings.prepared(rows, "p_partkey", ["p_brand", "models"], ["p_name"], ["kind"]), 5).write.parquet(f"{out}/manuals")
    manuals = t.spark.read.parquet(f"{out}/manuals")
    postings.postings(manuals).write.parquet(f"{out}/grams")
    said = t.part.select(F.concat_ws(" ", F.get(F.split("p_name", " "), F.lit(0)), (F.col("p_size") % 30).cast("string")).alias("text"), F.col("p_type").alias("kind")).distinct()
    questions = said.select(F.struct("text", "kind").alias("question"), "text", F.create_map(F.lit("kind"), F.array("kind")).alias("facets"))
    found = postings.search_many(manuals, t.spark.read.parquet(f"{out}/grams"), questions, ["kind"], 5)
    return found.select("question.text", "question.kind", "key", "score", "rank")


def _brand_files(t: Tables) -> str:
    """A text file a brand, of its names in order on one line; the folder."""
    out = t.folder()
    t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.array_join(F.array_sort(F.collect_list("p_name")), ",").alias("value")).write.partitionBy("brand").text(out)
    return out


def _brand_of(path: str) -> F.Column:
    return F.url_decode(F.url_decode(F.regexp_extract(path, "brand=([^/]+)", 1))).alias("brand")  # a path in a path


@query("SELECT p_brand AS brand, string_agg(p_name, ',' ORDER BY p_name) || chr(10) AS text FROM part GROUP BY 1")
def text_tree(t: Tables) -> DataFrame:
    """The files of a folder, each whole."""
    return files.read_tree(t.spark, _brand_files(t), "*.txt").select(_brand_of("path"), "text")


@query("""
WITH f AS (SELECT p_brand AS brand, string_agg(p_name, ',' ORDER BY p_name) || chr(10) AS text FROM part GROUP BY 1)
SELECT brand, strlen(text) AS size, sha256(text) AS sha256 FROM f""")
def release_files(t: Tables) -> DataFrame:
    """Sizes and hashes of the files of a release."""
    return files.file_inventory(t.spark, _brand_files(t), "*.txt").select(_brand_of("path"), "size", "sha256")


@query("""
WITH r AS (SELECT p_partkey, p_brand, p_type, p_size % 5 AS o, CASE WHEN p_partkey % 10 = 0 THEN 'Value TBD' ELSE p_name END AS txt FROM part)
SELECT 'order_collision' AS rule, count(*) AS n FROM (SELECT p_brand, o FROM r GROUP BY 1, 2 HAVING count(DISTINCT p_type) > 1)
UNION ALL SELECT 'exact_repeat', sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM r GROUP BY p_brand, p_type, o, txt HAVING count(*) > 1)
UNION ALL SELECT 'script_mismatch', count(*) FROM r WHERE p_partkey % 3 = 0 UNION ALL SELECT 'bad_slot_key', count(*) FROM r WHERE p_partkey % 7 = 0 UNION ALL SELECT 'suspect_value', count(*) FROM r WHERE p_partkey % 10 = 0""")
def section_audit(t: Tables) -> DataFrame:
    """Findings on sections, counted by rule: shared orders, repeats, text in the wrong script, malformed slots, unfinished values."""
    k = F.col("p_partkey")
    rows = t.part.select(
        k.alias("line"), F.col("p_brand").alias("doc"), F.col("p_type").alias("section"), (F.col("p_size") % 5).cast("string").alias("ord"), F.when(k % 10 == 0, "Value TBD").otherwise(F.col("p_name")).alias("txt"),
        F.when(k % 7 == 0, "bad slot!").otherwise("a.b").alias("slot"), F.when(k % 3 == 0, "zh").otherwise("en").alias("lang"),
    )
    return records.section_audit(rows, ["doc"], "section", "ord", "txt", "slot", "lang", "line").groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'new ' || p_brand ELSE p_name END AS v FROM part")
def repaired_cells(t: Tables) -> DataFrame:
    """Cells replaced from a repair list by brand and size, which lists some of them twice; the least replacement wins."""
    listed = t.part.where("p_size % 4 = 0").select("p_brand", "p_size", F.explode(F.array(F.concat(F.lit("new "), "p_brand"), F.concat(F.lit("newer "), "p_brand"))).alias("replacement"))
    return quality.repaired(t.part.select("p_partkey", "p_brand", "p_size", F.col("p_name").alias("v")), listed, ["p_brand", "p_size"], "v").select("p_partkey", "v")


@query("""
WITH RECURSIVE l AS (SELECT DISTINCT 'p' || p_partkey AS node, 's' || p_size AS source FROM part UNION SELECT DISTINCT 's' || p_size, 's' || (p_size // 2) FROM part WHERE p_size > 1),
w(root, node) AS (SELECT 'p' || p_partkey, 'p' || p_partkey FROM part UNION SELECT root, source FROM w JOIN l USING (node))
SELECT root, node FROM w""")
def file_lineage(t: Tables) -> DataFrame:
    """All that a release's files were made from: each part from its size's sheet, each sheet from that of half the size."""
    name = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    parts = t.part.select(name("p", F.col("p_partkey")).alias("node"), name("s", F.col("p_size")).alias("source"))
    sheets = t.part.where("p_size > 1").select(name("s", F.col("p_size")).alias("node"), name("s", F.floor(F.col("p_size") / 2)).alias("source"))
    return lineage.sources_of(parts.select(F.col("node").alias("root")), parts.unionByName(sheets), t.folder()).select("root", "node")


@contextmanager
def _state_store(t: Tables):  # noqa: ANN202
    """The session with the state store that stateful processors need, and as it was afterwards."""
    was = {k: t.spark.conf.get(k, None) for k in claims.STATE_STORE}
    try:
        for k, v in claims.STATE_STORE.items():
            t.spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            t.spark.conf.set(k, v) if v is not None else t.spark.conf.unset(k)


def _in_batches(t: Tables, rows: DataFrame, op, files: int = 4) -> DataFrame:  # noqa: ANN001
    """op over rows as a stream of files in order of `at`, a batch a file, with a restart from its checkpoint in the middle; read back."""
    out = t.folder()
    bounds = rows.repartitionByRange(files, "at").withColumn("__file", F.spark_partition_id())
    bounds.write.partitionBy("__file").parquet(f"{out}/all")
    with _state_store(t):
        for k in range(files):
            t.spark.read.schema(rows.schema).parquet(f"{out}/all/__file={k}").coalesce(1).write.mode("append").parquet(f"{out}/in")
            stream = t.spark.readStream.schema(rows.schema).parquet(f"{out}/in")
            made = op(stream)
            made.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(made.schema).parquet(f"{out}/rows")


@query()
def stream_claims(t: Tables) -> DataFrame:
    """Claims of users by event type, first in first out among the last 256, over all events in four batches, each by a query that starts anew."""
    rows = t.events.select(F.col("event_type").alias("scope"), F.col("user_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("at"))
    return _in_batches(t, rows, lambda s: claims.claims(s, most=256)).groupBy("scope", "id").agg(F.count("*").alias("n"), F.count_if("claimed").alias("claimed"))


@query("""
WITH e AS (SELECT *, event_type = 'purchase' AS ask FROM events WHERE event_type IN ('click', 'purchase')),
p AS (SELECT *, lag(event_type) OVER w AS before, lag(ts) OVER w AS since, lag(event_id) OVER w AS held FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts::VARCHAR AS at, coalesce(before = 'click' AND since + INTERVAL 6 HOUR > ts, false) AS matched, CASE WHEN before = 'click' AND since + INTERVAL 6 HOUR > ts THEN held::VARCHAR END AS payload FROM p WHERE ask""")
def pending_requests(t: Tables) -> DataFrame:
    """A click waits six hours for a purchase of its user, which takes it once; over all such events in four batches."""
    kind = F.when(F.col("event_type") == "click", "remember").otherwise("consume")
    rows = t.events.where("event_type in ('click', 'purchase')").select(F.lit("c").alias("chat_id"), F.col("user_id").cast("string").alias("sender_id"), F.col("ts").cast("timestamp").alias("at"), kind.alias("kind"), F.col("event_id").cast("string").alias("payload"), F.lit(6 * 3600.0).alias("ttl"))
    found = _in_batches(t, rows, claims.pending)
    return found.select(F.col("sender_id").cast("long").alias("user_id"), F.regexp_replace(F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0*$", "").alias("at"), "matched", "payload")
