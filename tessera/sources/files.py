"""Scans of CSV, ledgers, reports, text trees and Markdown; nothing is read through the driver."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.align import line_counts
from tessera.functions.text import filled


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, corrupt: str | None = None, missing_ok: bool = True) -> DataFrame:
    """A CSV with a header, quoted line breaks allowed, a byte-order mark ignored, all columns text.

    schema fixes the columns (else the header gives them). corrupt names a column that takes the raw text of rows
    with more cells than columns. A path that is not there gives an empty table if missing_ok (a schema is needed).
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False)
    if schema is not None:
        if corrupt:
            schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        reader = reader.schema(schema).option("enforceSchema", False)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        if missing_ok and schema is not None and "PATH_NOT_FOUND" in str(e):
            return empty(spark, schema)
        raise
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns if c.startswith("﻿")})


def with_lines(df: DataFrame) -> DataFrame:
    """Adds `line`, the ordinal of a record in file order plus 1 (the header is 1).

    The ordinal needs the number of rows in the partitions before, so the partitions are counted once (a small table)
    and no window spans the whole table.
    """
    tagged = df.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    sizes = tagged.groupBy("__p").agg(F.count("*").alias("n"), F.min("__i").alias("first"))
    ahead = sizes.withColumn("before", F.sum("n").over(W.orderBy("__p")) - F.col("n")).drop("n")  # a row per partition
    return tagged.join(F.broadcast(ahead), "__p").withColumn("line", F.col("before") + F.col("__i") - F.col("first") + 2).drop("__p", "__i", "first", "before")


def read_ledger(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, key: str | None = None) -> DataFrame:
    """One or more JSON-lines ledgers; a key seen in several (else the whole row) counts once, the first path's.

    Paths are numbered in the order given; lines that are not JSON are dropped."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    for i, p in enumerate(listed):
        try:
            parts.append(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(p).withColumn("__path", F.lit(i)))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    if not parts:
        return empty(spark, schema)
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    if len(parts) == 1 and key is None:
        return both.drop("__path")
    cols = [c for c in both.columns if c != "__path"]
    name = F.to_json(F.struct(*cols)) if key is None else F.coalesce(filled(key), F.to_json(F.struct(*cols)))
    best = both.withColumn("__k", name).groupBy("__k").agg(F.min_by(F.struct(*cols), "__path").alias("r"))
    return best.select("r.*")


def read_report(spark: SparkSession, path: str, item: T.StructType | str) -> DataFrame:
    """Findings of JSON report files, each a list or an object with a list `findings`; adds `file`."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    kind = item if isinstance(item, str) else item.simpleString()
    inner = kind if kind.startswith("struct<") else f"struct<{kind}>"
    listed = F.coalesce(F.from_json("value", f"array<{inner}>"), F.from_json("value", f"struct<findings: array<{inner}>>")["findings"])
    whole = F.when(F.trim("value").startswith("["), F.from_json("value", f"array<{inner}>")).otherwise(F.from_json("value", f"struct<findings: array<{inner}>>")["findings"])
    return text.select("file", F.explode(F.coalesce(whole, listed)).alias("x")).select("file", "x.*")


def read_tree(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, text): all files below a folder, each whole."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, sha256) of the files below a folder."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def inventory_hash(inventory: DataFrame) -> DataFrame:
    """One row (files, bytes, digest) that names a set of files whatever their order: sums of per-file hashes."""
    return inventory.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.hex(F.coalesce(F.bit_xor(F.xxhash64("path", "sha256")), F.lit(0))).alias("digest"))


def tree_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, status, added, removed): files of two versions of a tree that differ: A, D or M with the numbers of lines that a minimal
    edit script adds and removes. Paths are unique and not null; a null text is an empty file."""
    both = old.select("path", F.coalesce("text", F.lit("")).alias("o")).join(new.select("path", F.coalesce("text", F.lit("")).alias("n")), "path", "full").where(~F.col("o").eqNullSafe(F.col("n")))
    counts = line_counts(both.where("o is not null").select("path", "o"), both.where("n is not null").select("path", F.col("n").alias("o")), "path", "o")
    status = F.when(F.col("o").isNull(), "A").when(F.col("n").isNull(), "D").otherwise("M")
    return both.select("path", status.alias("status")).join(counts.withColumnRenamed("key", "path"), "path")


def path_dims(path: Column | str, root: str = "_review") -> Column:
    """(model, region, artifact, section) of .../root/model/region/artifact/section...; blank where there is no such part."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    at = F.array_position(parts, root).cast("int")
    part = lambda i: F.when(at > 0, F.coalesce(F.get(parts, at + i), F.lit(""))).otherwise("")
    return F.struct(*[part(i).alias(n) for i, n in enumerate(("model", "region", "artifact", "section"))])


def decode_records(df: DataFrame, envelope: str) -> DataFrame:
    """(record_id, fields map<string, json>): rows of a list envelope {"records": [{"record_id", "fields": {...}}]},
    or of the columnar one {"fields": [...], "record_id_list": [...], "data": [[...]]}."""
    rows = F.from_json(F.col(envelope), "struct<records: array<struct<record_id: string, fields: string>>, fields: array<string>, record_id_list: array<string>, data: array<string>>")
    named = F.transform(rows["records"], lambda r: F.struct(r["record_id"].alias("record_id"), _json_map(r["fields"]).alias("fields")))
    cells = lambda d: F.transform(F.from_json(d, "array<string>"), lambda v: F.coalesce(v, F.lit("null")))
    zipped = F.zip_with(rows["record_id_list"], rows["data"], lambda i, d: F.struct(i.alias("record_id"), F.map_from_arrays(rows["fields"], cells(d)).alias("fields")))
    return df.select(F.explode(F.coalesce(named, zipped)).alias("x")).select("x.*")


def _json_map(c: Column) -> Column:
    return F.from_json(c, "map<string,string>")


_CELLS = re.compile(r"(?<!\\)\|")


def markdown_tables(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, table_no, heading_path, row_no, header, cell): the cells of pipe tables with the headings they stand under."""

    def cells(line: str) -> list[str]:
        return [c.strip().replace("\\|", "|") for c in _CELLS.split(line.strip().strip("|"))]

    def rows(doc: str) -> Iterator[tuple[int, str, int, str, str]]:
        path: list[tuple[int, str]] = []
        header: list[str] = []
        table = row = 0
        before = ""
        for line in doc.splitlines():
            if m := re.match(r"(#{1,6})\s+(.*?)\s*#*$", line):
                path = [p for p in path if p[0] < len(m[1])] + [(len(m[1]), m[2])]
            bar = line.lstrip().startswith("|")
            if bar and header:
                row += 1
                for name, value in zip(header, cells(line), strict=False):
                    yield table, " > ".join(p[1] for p in path), row, name, value
            elif bar or re.match(r"\s*:?-+:?\s*\|", line):
                if re.fullmatch(r"[\s|:-]+", line) and "-" in line and "|" in before:
                    header, table, row = cells(before), table + 1, 0
            if not bar:
                header = []
            before = line

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, *r) for k, t in zip(b["key"], b["text"], strict=True) for r in rows(t or "")]
            yield pd.DataFrame(out, columns=["key", "table_no", "heading_path", "row_no", "header", "cell"])

    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(run, "key string, table_no int, heading_path string, row_no int, header string, cell string")


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, kind, text, norm, heading_level, heading_path): the lines of documents as blocks.

    Kinds: heading, list_item, table_row, image, paragraph; blank lines are left out. A heading's path is that of the
    headings above it, carried forward per level by windows inside the document.
    """
    from tessera.functions.text import inline_norm

    lines = docs.select(F.col(key).alias("key"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n")).alias("line_no", "raw")).where(F.trim("raw") != "")
    level = F.length(F.regexp_extract("raw", r"^(#{1,6})\s", 1))
    kind = F.when(level > 0, "heading").when(F.trim("raw").rlike(r"^\|"), "table_row").when(F.trim("raw").rlike(r"^!\["), "image").when(F.trim("raw").rlike(r"^(?:[-*•]|\d+[.)])\s"), "list_item").otherwise("paragraph")
    df = lines.withColumn("heading_level", level).withColumn("kind", kind).withColumn("text", F.trim(F.regexp_replace("raw", r"^#{1,6}\s+", "")))
    upto = W.partitionBy("key").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    at = [F.last(F.when(F.col("heading_level") == n, F.col("line_no")), ignorenulls=True).over(upto) for n in range(1, 7)]
    name = [F.last(F.when(F.col("heading_level") == n, F.col("text")), ignorenulls=True).over(upto) for n in range(1, 7)]
    df = df.withColumn("__at", F.array(*at)).withColumn("__name", F.array(*name))
    alive = lambda i: F.get("__at", i).isNotNull() & ~F.exists(F.slice("__at", F.lit(1), i), lambda p: F.coalesce(p > F.get("__at", i), F.lit(False)))
    path = F.array_join(F.filter(F.transform(F.col("__name"), lambda v, i: F.when(alive(i), v)), lambda v: v.isNotNull()), " > ")
    return df.select("key", F.col("line_no").alias("line_no"), "kind", "text", inline_norm("text").alias("norm"), "heading_level", path.alias("heading_path"))


def section(blocks_df: DataFrame, title: str) -> DataFrame:
    """The blocks from a heading of that title (letter case aside) to the next of its level or above, per document."""
    # windows over a document's blocks, which blocks() has laid together: a join by document would be planned by the size of the pages' file
    by, head = W.partitionBy("key"), F.col("kind") == "heading"
    start = F.min(F.when(head & (F.lower("norm") == title.strip().lower()), F.struct("line_no", "heading_level"))).over(by)
    stop = F.min(F.when(head & (F.col("line_no") > F.col("__s.line_no")) & (F.col("heading_level") <= F.col("__s.heading_level")), F.col("line_no"))).over(by)
    placed = blocks_df.where("key is not null").withColumn("__s", start).where("__s is not null").withColumn("__stop", stop)
    inside = (F.col("line_no") >= F.col("__s.line_no")) & (F.col("__stop").isNull() | (F.col("line_no") < F.col("__stop")))
    return placed.where(inside).select(*blocks_df.columns)


def _line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"))


def _texts_of(kept: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): the kept lines of each document put together; a document that keeps none has an empty text."""
    joined = kept.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias(text))
    return docs.select(F.col(key).alias("key")).distinct().join(joined, "key", "left").withColumn(text, F.coalesce(text, F.lit("")))


def in_languages(docs: DataFrame, key: str, text: str, langs: Sequence[str], page_lang: str = "en") -> DataFrame:
    """(key, text): pages that hold one block per language, without the blocks of other languages.

    A block begins with a bold line whose first word is a language's tag ('**FR ...'); what stands before the first is
    in the page's own language. Other bold lines are prose.
    """
    from tessera.sources.schema import ALIASES, LANGUAGES, canonical_language

    code = {a.upper(): c for c in LANGUAGES for a in ALIASES.get(c, (c,))}
    wanted = {canonical_language(x) for x in langs}
    tag = F.upper(F.regexp_extract("line", r"^\s*\*\*([A-Za-z][A-Za-z_-]{1,5})[ —-]", 1))
    own = F.element_at(F.create_map(*[F.lit(x) for kv in code.items() for x in kv]), F.nullif(tag, F.lit("")))
    upto = W.partitionBy("key").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    marked = _line_rows(docs, key, text).withColumn("lang", F.coalesce(F.last(own, ignorenulls=True).over(upto), F.lit(canonical_language(page_lang))))
    return _texts_of(marked.where(F.col("lang").isin(*wanted)), docs, key, text)


def without_sections(docs: DataFrame, key: str, text: str, lacking: DataFrame, begin: str = r"^\s*\.\. begin-capability: (\S+)", end: str = r"^\s*\.\. end-capability: (\S+)") -> DataFrame:
    """(key, text): texts without the marked spans of capabilities that the document lacks (key, capability), and without
    the markers of all others. A document that `lacking` does not name keeps every body. Spans are not nested."""
    upto = W.partitionBy("key").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    opened, closed = F.nullif(F.regexp_extract("line", begin, 1), F.lit("")), F.nullif(F.regexp_extract("line", end, 1), F.lit(""))
    rows = _line_rows(docs, key, text).withColumn("o", opened).withColumn("c", closed)
    inside = F.last(F.when(F.col("o").isNotNull(), F.col("o")).when(F.col("c").isNotNull(), F.lit("")), ignorenulls=True).over(upto)
    bare = rows.withColumn("capability", F.nullif(inside, F.lit(""))).where("o is null and c is null")
    gone = lacking.select("key", "capability").distinct().withColumn("__gone", F.lit(True))
    kept = bare.join(gone, ["key", "capability"], "left").where("__gone is null")
    return _texts_of(kept, docs, key, text)


def field_entries(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section, field, shown, value, pos): fields of marked-up pages: ':name: value' lines and the first two cells
    of table rows ('* - name' and '- value'), under the last underlined heading; repeats are shown as 'name #2'."""
    by = W.partitionBy("key").orderBy("line_no")
    after = F.lead("line").over(by)
    rows = _line_rows(docs, key, text).withColumn("after", F.coalesce(after, F.lit(""))).withColumn("head", F.when((F.trim("line") != "") & F.col("after").rlike(r"^([=~^\"'#*+-])\1{2,}\s*$"), F.trim("line")))
    placed = rows.withColumn("section", F.coalesce(F.last("head", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, 0)), F.lit("")))
    colon, cell = r"^\s*:([^:]+):\s*(\S.*)$", r"^\s*\*\s+-\s+(\S.*)$"
    field = F.when(F.col("line").rlike(colon), F.regexp_extract("line", colon, 1)).when(F.col("line").rlike(cell), F.regexp_extract("line", cell, 1))
    value = F.when(F.col("line").rlike(colon), F.regexp_extract("line", colon, 2)).otherwise(F.regexp_extract("after", r"^\s+-\s+(\S.*)$", 1))
    found = placed.select("key", "section", F.trim(field).alias("field"), F.trim(value).alias("value"), F.col("line_no").alias("pos")).where("field is not null and value <> ''")
    n = F.row_number().over(W.partitionBy("key", "section", "field").orderBy("pos"))
    return found.withColumn("shown", F.when(n > 1, F.concat("field", F.lit(" #"), n.cast("string"))).otherwise(F.col("field")))
