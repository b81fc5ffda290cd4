"""Text helpers, cells and marked-up pages on the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text, udfs, values, variants
from tessera.operators import lookup, predicates
from tessera.plans.registry import Tables, query
from tessera.sources import files, schema

def _n() -> Column:
    return F.col("p_size")


def _size() -> Column:
    return F.col("p_size").cast("string")


def _text(*parts: Column | str) -> Column:
    """Columns, and texts as they stand, in one text."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


@query("""
SELECT p_partkey, 'M' || p_size || CASE WHEN p_size % 4 = 2 THEN '_EU' WHEN p_size % 5 <> 0 OR p_size % 4 = 3 THEN '' WHEN p_size % 4 = 0 THEN '_US' ELSE '-us' END AS model,
  CASE p_size % 3 WHEN 2 THEN '' ELSE 'A,B 1' END AS models, p_name AS short FROM part""")
def model_names(t: Tables) -> DataFrame:
    model = _text("M", _size(), F.when(_n() % 4 == 0, "_US").when(_n() % 4 == 1, "-us").when(_n() % 4 == 2, "_EU").otherwise(""))
    listed = F.when(_n() % 3 == 0, "['A', 'B 1', 'A']").when(_n() % 3 == 1, "A| B 1,,A").otherwise(" ")
    return t.part.select(
        "p_partkey", text.model_token(model, F.when(_n() % 5 == 0, "").otherwise("US")).alias("model"), F.array_join(text.literal_list(listed), ",").alias("models"),
        text.short_name(_text(F.when(_n() % 2 == 0, " ACME  ").otherwise("Acme "), F.col("p_name")), "Acme").alias("short"),
    )


@query("""
SELECT p_partkey, 'press the USB button of ' || lower(p_brand) AS label, p_size % 3 = 0 AS wide, p_name || '.|' || p_brand || '!|' || p_type AS units, 'run.py:N failed ' || p_brand AS logged,
  CASE WHEN p_size % 2 = 0 THEN 'l\\_' || p_size || '\\*' ELSE '\\{' || p_size || '\\%\\}' END AS marked FROM part""")
def label_texts(t: Tables) -> DataFrame:
    said = _text(F.col("p_name"), ". ", F.col("p_brand"), "! ", F.col("p_name"), ".\n", F.col("p_type"))
    return t.part.select(
        "p_partkey", text.lowered_label(_text("Press  the USB BUTTON Of ", F.col("p_brand"))).alias("label"), text.is_east_asian(F.when(_n() % 3 == 0, "漢 x").when(_n() % 3 == 1, "éx").otherwise("x")).alias("wide"),
        F.array_join(text.sentences(said), "|").alias("units"), text.log_line(_text("/srv/a-b/", _size(), "/run.py:", _size(), ":3  failed ", F.col("p_brand"))).alias("logged"),
        F.when(_n() % 2 == 0, text.escaped(_text("l_", _size(), "*"), "rst")).otherwise(text.escaped(_text("{", _size(), "%}"), "latex")).alias("marked"),
    )


@query("""
SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 3 <> 0, CASE WHEN p_size % 3 = 0 THEN p_retailprice END, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN p_name ELSE '' END, p_partkey) AS place FROM part""")
def canonical_order(t: Tables) -> DataFrame:
    cell = F.when(_n() % 3 == 0, F.col("p_retailprice").cast("string")).when(_n() % 3 == 1, F.upper("p_name")).otherwise(" ")
    return lookup.ranked(t.part, ["p_brand"], [text.sort_token(cell), F.col("p_partkey")], "place").select("p_partkey", F.col("place").cast("long").alias("place"))


@query("SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type || ' ' || p_size AS items FROM part")
def list_items(t: Tables) -> DataFrame:
    page = _text("Intro\n- ", F.col("p_name"), "\n  2. ", F.col("p_brand"), "\nplain 1. no\n<ul><li>", F.col("p_type"), " <b>", _size(), "</b></li></ul>")
    return t.part.select("p_partkey", F.array_join(text.list_items(page), "|").alias("items"))


@query("""
WITH f AS (SELECT CAST(p_partkey AS VARCHAR) AS key, * FROM part)
SELECT key, p_brand AS section, 'width' AS field, 'width' AS shown, CAST(p_size AS VARCHAR) AS value, 2 AS pos FROM f UNION ALL SELECT key, p_brand, p_type, p_type, p_name, 3 FROM f
UNION ALL SELECT key, p_brand, 'width', 'width #2', p_name, 5 FROM f""")
def page_fields(t: Tables) -> DataFrame:
    page = _text(F.col("p_brand"), "\n=======\n:width: ", _size(), "\n   * - ", F.col("p_type"), "\n     - ", F.col("p_name"), "\n:width:  ", F.col("p_name"), "\nprose: none\n")
    return files.field_entries(t.part.select(F.col("p_partkey").cast("string").alias("k"), page.alias("page")), "k", "page")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'success' ELSE 'failed' END AS status, CASE WHEN p_size % 2 = 0 THEN 'a=' || p_size || ',b=x=' || p_name ELSE '' END AS fields FROM part")
def result_fields(t: Tables) -> DataFrame:
    said = F.when(_n() % 2 == 0, _text(" Success | a=1 | B = x=", F.col("p_name"), " | junk | A=", _size())).otherwise("FAILED")
    read = t.part.select("p_partkey", values.result_fields(said).alias("r"))
    return read.select("p_partkey", "r.status", F.array_join(F.transform(F.array_sort(F.map_entries("r.values")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("fields"))


@query("""
SELECT p_partkey, sha256('{"a":["' || p_name || '",null],"b":' || p_size || '}') AS digest, p_name || ', ' || p_brand AS choices,
  CASE p_size % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN '0.5' WHEN 3 THEN p_name || ', ' || p_size ELSE '' END AS cell FROM part""")
def json_cells(t: Tables) -> DataFrame:
    quoted = lambda c: F.to_json(F.struct(F.col(c).alias("text")))
    raw = F.when(_n() % 5 == 0, "true").when(_n() % 5 == 1, _text(_size(), ".0")).when(_n() % 5 == 2, "0.50").when(_n() % 5 == 3, _text('["', F.col("p_name"), '", ', _size(), "]"))
    return t.part.select(
        "p_partkey", udfs.content_hash(_text('{"b": ', _size(), ', "a": ["', F.col("p_name"), '", null]}')).alias("digest"),
        variants.choice_text(_text("[", quoted("p_name"), ', {"text": " ", "name": "', F.col("p_brand"), '"}, {}]')).alias("choices"), variants.cell_text(raw).alias("cell"),
    )


@query("""
SELECT p_name AS Variable_key, '' AS Model_key, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS Model, CAST(p_size AS VARCHAR) AS Value,
  CASE p_size % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'maybe' ELSE '' END AS is_default FROM part""")
def normalised_rows(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_name").alias("Variable_key"), F.when(_n() % 2 == 0, F.col("p_brand")).otherwise(" ").alias("Model"), F.col("p_type").alias("Models"), _n().alias("Value"),
        F.when(_n() % 4 == 0, "Yes").when(_n() % 4 == 1, "0").when(_n() % 4 == 2, "maybe").alias("is_default"), F.lit("no column of the table").alias("Extra"),
    )
    return schema.normalised(raw, schema.TABLES["variable_defaults"], {"Model": ["Models"]})


@query("SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN c_name WHEN c_nationkey % 3 = 1 THEN c_mktsegment ELSE '' END AS first_one FROM customer")
def first_filled(t: Tables) -> DataFrame:
    n = F.col("c_nationkey") % 3
    return t.customer.select("c_custkey", text.first_filled(F.lit(" "), F.when(n == 0, F.concat(F.col("c_name"), F.lit(" "))), F.when(n == 1, F.col("c_mktsegment"))).alias("first_one"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 IN (1, 2) THEN 'front' ELSE '' END AS placement, CASE WHEN p_size % 4 = 2 THEN 'v' || p_size ELSE '' END AS variant, lower(p_type) AS role,
  CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'front.' ELSE 'front.v' || p_size || '.' END || lower(p_type) AS slot FROM part WHERE p_size % 4 <> 3""")
def slot_keys(t: Tables) -> DataFrame:
    cell = F.when(_n() % 4 == 0, F.lower("p_type")).when(_n() % 4 == 1, _text("front.", F.lower("p_type"))).when(_n() % 4 == 2, _text(" front.v", _size(), ".", F.lower("p_type"))).otherwise("a.b.c.d")
    read = t.part.select("p_partkey", predicates.slot_parts(cell).alias("s")).where("s is not null").select("p_partkey", "s.*")
    return read.withColumn("slot", predicates.slot_key("placement", "variant", "role"))


@query("SELECT p_partkey FROM part QUALIFY p_size = 1 OR NOT bool_or(p_size = 1) OVER (PARTITION BY p_brand)")
def whole_set_fallback(t: Tables) -> DataFrame:
    kept = t.part.withColumn("kept", predicates.all_if_none(F.col("p_size") == 1, "p_brand"))
    return kept.where("kept").select("p_partkey")


@query("""
SELECT p_partkey, p_size % 3 <> 2 AS symbol, p_size % 2 = 0 OR p_size % 5 = 0 AS trouble, p_size % 7 < 2 AS asset FROM part""")
def target_filters(t: Tables) -> DataFrame:
    market = F.when(_n() % 3 == 0, "EU、US").when(_n() % 3 == 1, "Global").otherwise("")
    region = F.when(_n() % 5 == 0, "ALL").when(_n() % 2 == 0, "").otherwise("JP|KR")
    asset = F.when(_n() % 7 == 0, "us").when(_n() % 7 == 1, "All").otherwise("")
    target = F.lit("US")
    return t.part.select("p_partkey", predicates.applies(market, target, "symbol_market").alias("symbol"), predicates.applies(region, target, "trouble_region").alias("trouble"), predicates.applies(asset, target, "asset").alias("asset"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'en,fr,pt-BR' WHEN 1 THEN 'fr,pt-BR' ELSE '' END AS langs FROM part")
def language_scope(t: Tables) -> DataFrame:
    langs = F.array(*map(F.lit, ("en", "fr", "pt-BR")))
    scope = F.when(_n() % 3 == 1, F.array(F.lit("PT-br"), F.lit("FR"))).when(_n() % 3 == 2, F.array(F.lit("de")))
    return t.part.select("p_partkey", F.array_join(lookup.narrowed(langs, scope), ",").alias("langs"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, 'intro' || chr(10) || '**Bold** prose' || CASE WHEN p_size % 2 = 0 THEN chr(10) || '**FR titre' || chr(10) || p_name ELSE '' END AS page FROM part")
def language_blocks(t: Tables) -> DataFrame:
    page = _text("intro\n**Bold** prose\n**DE titel\n", F.col("p_brand"), F.when(_n() % 2 == 0, _text("\n**FR titre\n", F.col("p_name"))).otherwise(""), "\n**JP x\ny")
    return files.in_languages(t.part.select(F.col("p_partkey").cast("string").alias("k"), page.alias("page")), "k", "page", ["EN", "fr"])


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS key, 'top' || CASE WHEN p_size % 2 = 0 THEN '' ELSE chr(10) || p_name END || chr(10) || 'end' AS page FROM part""")
def capability_sections(t: Tables) -> DataFrame:
    docs = t.part.select(F.col("p_partkey").cast("string").alias("k"), _text("top\n.. begin-capability: wifi\n", F.col("p_name"), "\n.. end-capability: wifi\nend").alias("page"))
    lacking = t.part.where("p_size % 2 = 0").select(F.col("p_partkey").cast("string").alias("key"), F.lit("wifi").alias("capability"))
    return files.without_sections(docs, "k", "page", lacking)


def _headed(t: Tables) -> DataFrame:
    """A page for each part: two headings of the second level under one of the first, and lines of other kinds."""
    page = _text("# ", F.col("p_type"), "\n\n- ", F.col("p_name"), "\n## Notes\n**", F.col("p_brand"), "**  text\n### Deep\n| a | b |\n## Last\n![x](y.png)")
    return files.blocks(t.part.select(F.col("p_partkey").cast("string").alias("k"), page.alias("page")), "k", "page")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS key, unnest([0, 2, 3, 4, 5, 6, 7, 8]) AS line_no, unnest(['heading', 'list_item', 'heading', 'paragraph', 'heading', 'table_row', 'heading', 'image']) AS kind,
  unnest([p_type, '- ' || p_name, 'Notes', p_brand || ' text', 'Deep', '| a | b |', 'Last', '[image]']) AS norm,
  unnest([p_type, p_type, p_type || ' > Notes', p_type || ' > Notes', p_type || ' > Notes > Deep', p_type || ' > Notes > Deep', p_type || ' > Last', p_type || ' > Last']) AS heading_path FROM part""")
def page_blocks(t: Tables) -> DataFrame:
    return _headed(t).select("key", "line_no", "kind", "norm", "heading_path")


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, unnest([3, 4, 5, 6]) AS line_no, unnest(['Notes', p_brand || ' text', 'Deep', '| a | b |']) AS norm FROM part")
def page_section(t: Tables) -> DataFrame:
    return files.section(_headed(t), "notes").select("key", "line_no", "norm")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS key, 1 AS table_no, p_type || ' > Data' AS heading_path, unnest([1, 1, 2, 2]) AS row_no, unnest(['Name', 'Size', 'Name', 'Size']) AS header,
  unnest([p_name, CAST(p_size AS VARCHAR), 'a|b', '']) AS cell FROM part""")
def markdown_tables(t: Tables) -> DataFrame:
    page = _text("# ", F.col("p_type"), "\n## Data\n| Name | Size |\n| --- | :-: |\n| ", F.col("p_name"), " | ", _size(), " |\n| a\\|b | |\n\nend | of\n")
    return files.markdown_tables(t.part.select("p_partkey", page.alias("page")), "p_partkey", "page")


@query("SELECT p_partkey, 'm' || p_size AS model, CASE WHEN p_size % 2 = 0 THEN 'EU' ELSE 'US' END AS region, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS artifact, '' AS section FROM part")
def path_parts(t: Tables) -> DataFrame:
    path = _text("/x/_review/m", _size(), F.when(_n() % 2 == 0, "/EU").otherwise("/US"), F.when(_n() % 3 == 0, "").otherwise(_text("/", F.col("p_brand"))))
    return t.part.select("p_partkey", files.path_dims(path).alias("d")).select("p_partkey", "d.*")


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN 'A_' || p_size || '_xx' ELSE 'A_' || p_size END AS model, CASE p_size % 3 WHEN 0 THEN 'eu' WHEN 1 THEN 'US' ELSE '' END AS region,
  CASE p_size % 3 WHEN 0 THEN 'fr_x' ELSE '' END AS rest FROM part""")
def split_targets(t: Tables) -> DataFrame:
    name = _text("A_", _size(), F.when(_n() % 3 == 0, "_eu_fr_x").when(_n() % 3 == 1, "_US").otherwise("_xx"))
    return t.part.select("p_partkey", text.split_target(name, ["EU", "US"]).alias("s")).select("p_partkey", "s.*")
