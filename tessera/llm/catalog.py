"""The queries of this package, by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, chat, decontaminate, licenses, line_dedup, merkle, mixing, simhash, suffix_dedup, token_files, toxicity, urls, vector_codes
from tessera.llm.common import shared_dir, table, tokenizer_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    evidence = F.array_join(F.transform("evidence", lambda e: F.concat(e["doc_id"].cast("string"), F.lit(":"), e["label"].cast("string"))), ",")
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", evidence.alias("evidence"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.preferences(turns, chat.paired_by_id(turns))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, sources = mixing.mix_with_sources(table(spark, sf_dir, "documents"))
    plan = mixing.tilted(sources)
    both = mixing.curriculum_by_pass(mixing.curriculum(mixed, plan).withColumnRenamed("position", "by_size"), plan)
    return both.select("doc_id", "size", "source_size", "target", "taken", F.col("by_size").alias("position"), F.col("position").alias("position_taken"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/tokens/{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return token_files.checksums(spark, folder)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
b AS (SELECT doc_id, i, {'d': doc_id, 'i': i} AS place, trim(raw) AS line FROM l WHERE trim(raw) <> ''),
d AS (SELECT line, min(place) AS first, string_split(line, ' ') AS w FROM b GROUP BY line),
f AS (SELECT * FROM d WHERE len(w) >= 8),
v AS (
  SELECT first, len(w) AS n, p, md5(array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ')) AS g
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM f)),
e AS (
  SELECT first FROM (SELECT first, min(first) OVER (PARTITION BY n, p, g) AS e FROM v) WHERE e < first
  UNION SELECT greatest(v.first, f.first) FROM v JOIN f ON v.g = md5(f.line) AND v.n = len(f.w) + 1),
x AS (
  SELECT b.doc_id, b.i FROM b JOIN d USING (line)
  WHERE b.place > d.first OR d.first IN (SELECT first FROM e))
SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone) AS lines_removed
FROM (SELECT l.doc_id, l.i, l.raw, x.i IS NOT NULL AS gone FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i)
GROUP BY doc_id
"""
OP1_SQL = f"SELECT doc_id, coalesce(kept, '') AS text, lines_removed FROM ({OP1_SQL})"

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN bw USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP4_SQL = r"""
WITH t AS (
  SELECT license, row_number() OVER () AS k, regexp_extract_all(lower(notice), '[a-z0-9]+') AS w FROM (VALUES {notices}) AS v(license, notice)),
g AS (SELECT k, license, len(w) AS n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM t),
tb AS (SELECT k, unnest(b) AS b FROM g),
l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
x AS (
  SELECT doc_id, line_no, unnest(w) AS word, unnest(range(len(w))) AS j FROM (
    SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w FROM l)),
y AS (SELECT doc_id, line_no, word, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, j) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS total FROM x),
p AS (SELECT * FROM (SELECT doc_id, line_no, i, total, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM y) WHERE b IS NOT NULL),
h AS (
  SELECT doc_id, k, i, least(n, total) AS m, total, ceil(len(g.b) * 0.8 / 1.2 - 1e-9) AS need FROM p JOIN tb USING (b) JOIN g USING (k)
  QUALIFY count(*) OVER (PARTITION BY doc_id, k) >= ceil(len(g.b) * 0.8 / 1.2 - 1e-9)),
c AS (
  SELECT doc_id, k, s, m FROM (SELECT doc_id, k, m, need, unnest(range(greatest(0, i - m + 2), least(i, total - m) + 1)) AS s FROM h)
  GROUP BY doc_id, k, s, m, need HAVING count(*) >= need),
d AS (
  SELECT c.doc_id, c.k, s, m, min(p.line_no) AS line_no, count(DISTINCT p.b) AS held, count(DISTINCT tb.b) AS own
  FROM c JOIN p ON p.doc_id = c.doc_id AND p.i BETWEEN s AND s + m - 2 LEFT JOIN tb ON tb.k = c.k AND tb.b = p.b GROUP BY c.doc_id, c.k, s, m),
f AS (SELECT DISTINCT doc_id, line_no, s, m, license, 2.0 * own / (held + len(g.b)) AS dice FROM d JOIN g USING (k) WHERE 2.0 * own / (held + len(g.b)) >= 0.8),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, m DESC, license, s) AS place FROM f)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, s AS word, m AS n_words, license, CAST(dice AS DOUBLE) AS dice FROM r
WHERE NOT EXISTS (SELECT 1 FROM r AS o WHERE o.doc_id = r.doc_id AND o.place < r.place AND o.s < r.s + r.m AND r.s < o.s + o.m)
"""


def _op4_sql() -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    return OP4_SQL.replace("{notices}", ", ".join(f"({quoted(k)}, {quoted(t)})" for k, texts in licenses.TEMPLATES.items() for t in texts))


OP5_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY coalesce(role, ''), coalesce(text, '')) = 1),
s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, '<|' || role || '|>' || chr(10) || text || chr(10) AS shown FROM r),
p AS (
  SELECT conv_id // 2 AS pair_id, min(conv_id) AS chosen_id, max(conv_id) AS rejected_id FROM (SELECT DISTINCT conv_id FROM r)
  GROUP BY conv_id // 2 HAVING count(*) = 2),
m AS (
  SELECT pair_id, min(coalesce(a.i, b.i)) AS first_off
  FROM p JOIN s a ON a.conv_id = chosen_id FULL JOIN (SELECT s.*, pair_id AS pid FROM p JOIN s ON s.conv_id = rejected_id) b ON b.pid = pair_id AND a.i = b.i
  WHERE a.i IS NULL OR b.i IS NULL OR a.role <> b.role OR a.text <> b.text GROUP BY pair_id),
m2 AS (
  SELECT p.*, least(coalesce(first_off, 1000000000),
    coalesce((SELECT max(i) FROM s WHERE conv_id = chosen_id), 0) + 1, coalesce((SELECT max(i) FROM s WHERE conv_id = rejected_id), 0) + 1) - 1 AS n
  FROM p LEFT JOIN m USING (pair_id)),
x AS (
  SELECT m2.pair_id, s.conv_id = rejected_id AS rej, s.*, n, i <= n AS pre,
    sum(length(shown)) OVER (PARTITION BY s.conv_id, i <= n ORDER BY i) - length(shown) AS start
  FROM m2 JOIN s ON s.conv_id IN (chosen_id, rejected_id)),
y AS (
  SELECT pair_id,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE pre AND NOT rej), '') AS prompt,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE NOT pre AND NOT rej), '') AS chosen,
    coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE NOT pre AND rej), '') AS rejected,
    coalesce(string_agg((start + length(role) + 5)::VARCHAR || '-' || (start + length(role) + 5 + length(text))::VARCHAR, ',' ORDER BY i) FILTER (WHERE NOT pre AND NOT rej AND role = 'assistant'), '') AS chosen_mask,
    coalesce(string_agg((start + length(role) + 5)::VARCHAR || '-' || (start + length(role) + 5 + length(text))::VARCHAR, ',' ORDER BY i) FILTER (WHERE NOT pre AND rej AND role = 'assistant'), '') AS rejected_mask
  FROM x GROUP BY pair_id)
SELECT m2.pair_id, chosen_id, rejected_id, n AS prompt_turns, prompt, chosen, chosen_mask, rejected, rejected_mask FROM m2 JOIN y USING (pair_id)
"""

OP8_SQL = r"""
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM a)
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict
FROM b LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) = 1
"""

OP6_SQL = r"""
WITH z AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM z GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(k - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0 * source_size AS cap FROM s),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT *, least(cap, weight * coalesce((SELECT arg_min(level, cap / weight) FROM l WHERE level * weight <= cap), 'inf'::DOUBLE)) AS target FROM l),
p AS (
  SELECT z.doc_id, z.size, t.source_size, t.target, t.k, t.weight, round(t.target)::BIGINT AS goal,
    sum(z.size) OVER (PARTITION BY t.k ORDER BY md5(CAST(doc_id AS VARCHAR)) NULLS LAST, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - z.size AS before
  FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, goal // greatest(source_size, 1) * size + greatest(0, least(size, goal - goal // greatest(source_size, 1) * source_size - before)) AS taken,
    CASE WHEN source_size > 0 THEN before / source_size END AS q, CASE WHEN goal > 0 THEN before / goal END AS qt,
    CASE WHEN k % 2 = 1 THEN 0.5 ELSE 1.5 END AS a, CASE WHEN k % 2 = 1 THEN 1.5 ELSE 0.5 END AS b FROM p)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN (sqrt(a * a + 2 * (b - a) * q) - a) / (b - a) END AS position,
  CASE WHEN taken > 0 THEN (sqrt(a * a + 2 * (b - a) * qt) - a) / (b - a) END AS position_taken FROM r
"""


OP12_SQL = r"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(x)) // 4 AS m FROM v),
x AS (SELECT vec_id, label, p, x[p * m + 1 : p * m + m] AS x FROM v, w, range(4) AS r(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS e FROM x QUALIFY k < 256)
"""

#: One round: assign every part, then move the entries.
OP12_ROUND = r"""
, a{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'k': k}}) AS best FROM (
    SELECT vec_id, x.p, k, x, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i])))::BIGINT AS d FROM x JOIN b{r} USING (p))
  GROUP BY vec_id, p),
s{r} AS (
  SELECT p, k, list(t ORDER BY j) AS t FROM (
    SELECT p, k, j, (s - ((s % c) + c) % c) // c AS t FROM (
      SELECT p, best.k AS k, j, sum(x[j])::BIGINT AS s, count(*) AS c FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS j FROM a{r}) GROUP BY p, best.k, j))
  GROUP BY p, k),
b{n} AS MATERIALIZED (SELECT p, k, coalesce(t, e) AS e FROM b{r} LEFT JOIN s{r} USING (p, k))
"""


def _op12_sql(rounds: int = 4) -> str:
    last = OP12_ROUND.format(r=rounds, n=rounds + 1).split(f"s{rounds} AS")[0].rstrip().removesuffix(",")
    return OP12_SQL + "".join(OP12_ROUND.format(r=r, n=r + 1) for r in range(rounds)) + last + rf"""
, c AS (SELECT vec_id, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id),
g AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM c JOIN v USING (vec_id), g
"""


def _op13_sql(levels: int = 14) -> str:
    """Up to 3 ** levels rows a source, and as many sources."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    step = "list_reduce([4294967295] || flatten(list_transform(range(1, strlen(d) + 1), lambda i: [ascii(d[i]), 0, 0, 0, 0, 0, 0, 0])), lambda c, v: CASE WHEN xor(c, v) & 1 = 1 THEN xor(xor(c, v) >> 1, 3988292384) ELSE xor(c, v) >> 1 END)"

    def tree(t: str, first: str, asked: str) -> str:
        """CTEs {t}0, {t}1, ...: the nodes (g, i, h, n) of each level; {t}f0, ...: what each asked row (doc_id, g, i, acc, proof) has folded."""
        out = f"{t}0 AS ({first}), {t}f0 AS ({asked})"
        for k in range(levels):
            out += f""",
{t}r{k} AS (SELECT g, i // 3 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {t}{k} GROUP BY g, i // 3),
{t}{k + 1} AS MATERIALIZED (SELECT g, i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 2) // 3 AS n FROM {t}r{k}),
{t}f{k + 1} AS MATERIALIZED (
  SELECT doc_id, g, i, CASE WHEN n > 1 THEN sha256(l || acc || r) ELSE acc END AS acc, CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof FROM (
    SELECT f.*, n, array_to_string(hs[1 : f.i // {3**k} % 3], '') AS l, array_to_string(hs[f.i // {3**k} % 3 + 2 :], '') AS r
    FROM {t}f{k} f JOIN {t}r{k} x ON x.g IS NOT DISTINCT FROM f.g AND x.i = f.i // {3 ** (k + 1)}))"""
        return out

    rows = tree(
        "t",
        "SELECT doc_id, source AS g, row_number() OVER w - 1 AS i, h, seen, count(*) OVER (PARTITION BY source) AS n FROM c WINDOW w AS (PARTITION BY source ORDER BY doc_id)",
        "SELECT doc_id, g, i, seen AS acc, '' AS proof FROM t0",
    )
    sources = tree(
        "u",
        f"SELECT g AS source, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n FROM t{levels}",
        f"SELECT doc_id, 0 AS g, u0.i, acc, proof FROM tf{levels} f JOIN u0 ON u0.source IS NOT DISTINCT FROM f.g",
    )
    return f"""
WITH d AS (SELECT doc_id, source, {leaf("text")} AS h, {leaf("replace(text, chr(10), '')")} AS th, doc_id::VARCHAR AS d FROM documents),
c AS (SELECT doc_id, source, h, CASE WHEN xor({step}, 4294967295) % 2 = 0 THEN th ELSE h END AS seen FROM d),
{rows},
{sources}
SELECT doc_id, t0.h AS leaf, u0.h AS subroot, u{levels}.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = u{levels}.h AS verified
FROM t0 JOIN uf{levels} f USING (doc_id) JOIN u0 ON u0.source IS NOT DISTINCT FROM t0.g, u{levels}
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_decontaminate, op3_toxicity, op4_licenses, op5_chat, op6_mixing, op7_simhash, op8_urls, op9_neighbours, op10_suffix_dedup, op11_token_files, op12_vector_codes, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op2_decontaminate": OP2_SQL, "op4_licenses": _op4_sql(), "op5_chat": OP5_SQL, "op6_mixing": OP6_SQL, "op8_urls": OP8_SQL, "op12_vector_codes": _op12_sql(), "op13_merkle": _op13_sql()}
