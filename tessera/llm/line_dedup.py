"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

A line is read as its words (trimmed, parted by single spaces). Exact repeats are collapsed first. Of the
distinct lines, those that share no half with another line cannot be one word edit away from any and stop
there: of two lines with a common variant of t words, both hold the variant's first half or both its second.
The rest emit every variant with one word deleted as a hashed key. Lines with the same variant and deleted
place differ in that word alone, so all of them are linked to their earliest; a line that is another's variant
is that line less a word. Links are verified word by word, and a line with an earlier link is removed.

The hash of all n variants of a line comes from two running sums (xor of position-dependent word hashes), so
that a long line costs no more per word than a short one. Groups are aggregates and joins throughout: a key
that very many lines share is combined map-side and yields one link per line, never all its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import row_keys, written

_ID = ["h1", "h2"]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(place <no_id, id, k1, k2, line_no>, line, h1, h2): the non-blank lines of every document row."""
    text = F.col(text_col).cast("string")
    k1, k2 = row_keys(F.col(id_col).cast("long"), text)
    cut = docs.select(F.col(id_col).cast("long").alias("id"), k1.alias("k1"), k2.alias("k2"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "raw"))
    line = cut.withColumn("line", F.trim("raw")).where("line <> ''").drop("raw")
    h1, h2 = row_keys("line")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "line_no")
    return line.select(place.alias("place"), "line", h1.alias("h1"), h2.alias("h2"))


def _halves(line: Column, n: Column) -> list[Column]:
    """Hashes of the halves that a variant of n - 1 or of n words has in common with the line."""
    out = []
    for short in (1, 0):
        t = n - short
        first = F.floor(t / 2).cast("int")
        for side, part in ((0, F.call_function("substring_index", line, F.lit(" "), first)), (1, F.call_function("substring_index", line, F.lit(" "), first - t))):
            out.append(F.xxhash64(t, F.lit(side), part))
    return out


def _words(line: str) -> Column:
    return F.split(F.col(line), " ", -1)


def _one_edit(a: str, b: str) -> Column:
    """Whether two different lines are one word apart: replaced, inserted or deleted."""
    x, y = _words(a), _words(b)
    gap = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False).cast("int")
    rest = lambda words, skip: F.slice(words, gap + skip, F.greatest(F.size(words) - gap - skip + 1, F.lit(0)))
    short, long = F.when(F.size(x) <= F.size(y), x).otherwise(y), F.when(F.size(x) <= F.size(y), y).otherwise(x)
    return F.when(F.size(x) == F.size(y), rest(x, 1) == rest(y, 1)).when(F.size(long) - F.size(short) == 1, rest(short, 0) == rest(long, 1)).otherwise(False)


def near_lines(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, kept): distinct lines that have an earlier line one word edit away, with that line's place.

    The texts of the lines that share a half are cut from the documents in which they first stand.
    """
    keyed = distinct.where("a is not null").select(*_ID, F.explode(F.array("a", "b", "c", "d")).alias("half"))
    shared = keyed.groupBy("half").count().where("count > 1").select("half")
    alive = keyed.join(shared, "half", "left_semi").select(*_ID).distinct()
    asked = distinct.join(alive, _ID).groupBy(F.col("first")["k1"].alias("k1"), F.col("first")["k2"].alias("k2")).agg(F.collect_list(F.struct(F.col("first").alias("place"), *_ID)).alias("asked"))
    asked = written(asked)  # a list is as long as a text has lines
    text = F.col(text_col).cast("string")
    k1, k2 = row_keys(F.col(id_col).cast("long"), text)
    held = docs.select(k1.alias("k1"), k2.alias("k2"), text.alias("text")).where("text is not null").join(asked, ["k1", "k2"])
    cut = held.select(F.array(F.split("text", "\n", -1)).alias("parts"), "asked")  # splits the text once
    cut = cut.select(F.explode(F.flatten(F.transform("parts", lambda p: F.transform("asked", lambda a: F.struct(a["place"].alias("place"), a["h1"].alias("h1"), a["h2"].alias("h2"), F.trim(F.get(p, a["place"]["line_no"])).alias("line")))))).alias("x"))
    found = cut.select("x.*").dropDuplicates(_ID).orderBy("place")  # rows that agree in id and text share their places
    texts = written(found.select(F.monotonically_increasing_id().alias("i"), "place", *_ID, "line", F.size(_words("line")).alias("n")))  # i: in order of place

    each = texts.select("i", "n", F.posexplode(_words("line")).alias("p", "w"))
    each = each.withColumn("x", F.xxhash64("w", "p")).withColumn("y", F.xxhash64("w", F.col("p") - 1))
    upto, whole = W.partitionBy("i").orderBy("p"), W.partitionBy("i")
    before = F.bit_xor("x").over(upto.rowsBetween(W.unboundedPreceding, 0)).bitwiseXOR(F.col("x"))
    after = F.bit_xor("y").over(whole).bitwiseXOR(F.bit_xor("y").over(upto.rowsBetween(W.unboundedPreceding, 0)))
    full = F.when(F.col("p") == 0, F.bit_xor("x").over(whole))
    variants = written(each.select("i", (F.col("n") - 1).alias("t"), "p", before.bitwiseXOR(after).alias("key"), full.alias("full")))

    groups = variants.groupBy("t", "key", "p").agg(F.min("i").alias("e"), F.count("*").alias("c")).where("c > 1").drop("c")
    swapped = variants.select("t", "key", "p", "i").join(groups, ["t", "key", "p"]).where("i > e").select("i", "e")
    wholes = variants.where("p = 0").select((F.col("t") + 1).alias("t"), F.col("full").alias("key"), F.col("i").alias("e"))
    pairs = variants.select("t", "key", "i").join(wholes, ["t", "key"])
    links = swapped.unionByName(pairs.select(F.greatest("i", "e").alias("i"), F.least("i", "e").alias("e"))).distinct()

    left, right = texts.select("i", F.col("line").alias("a_line")), texts.select(F.col("i").alias("e"), F.col("line").alias("b_line"))
    kept = links.join(left, "i").join(right, "e").where(F.col("a_line") != F.col("b_line")).where(_one_edit("a_line", "b_line")).groupBy("i").agg(F.min("e").alias("e"))
    return kept.join(texts.select("i", *_ID), "i").join(texts.select(F.col("i").alias("e"), F.col("place").alias("kept")), "e").select(*_ID, "kept")


def removed_lines(docs: DataFrame, near_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k1, k2, line_no, kept): the lines to remove, by row key, with the place of the line kept for each.

    A non-blank line goes if an equal line stands earlier (by id, nulls last, then row key, then line number), or
    if it has near_words words or more and an earlier distinct line is one word edit away.
    """
    lines = _lines(docs, id_col, text_col)
    n = F.length("line") - F.length(F.translate("line", " ", "")) + 1
    halves = [F.when(F.col("n") >= near_words, h).alias(c) for c, h in zip("abcd", _halves(F.col("line"), F.col("n")), strict=True)]
    sized = lines.withColumn("n", n.cast("int")).select("place", *_ID, *halves)
    distinct = written(sized.groupBy(*_ID).agg(F.min("place").alias("first"), F.count("*").alias("copies"), *[F.max(c).alias(c) for c in "abcd"]))
    near = near_lines(docs, distinct, id_col, text_col)
    bad = written(distinct.select(*_ID, "first", "copies").join(near, _ID, "left").where("copies > 1 or kept is not null"))  # its own table: a join partition with a frequent line can be split
    return lines.select("place", *_ID).join(bad, _ID).where("place <> first or kept is not null").select("place.k1", "place.k2", "place.line_no", F.coalesce("kept", "first").alias("kept"))


def dedup_lines(docs: DataFrame, near_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the repeated lines of text_col taken out, and `lines_removed` (long).

    Blank lines stay. A null text stays null and an empty one empty; a text whose lines all go is empty unless it
    had blank lines. Rows that agree in id and text are one document: each gets that document's result. Null ids
    come last in the order. An empty table gives no rows. Other columns of docs pass through, but
    for a `lines_removed` of its own.
    """
    gone = removed_lines(docs, near_words, id_col, text_col).select("k1", "k2", "line_no").distinct()
    lists = gone.groupBy("k1", "k2").agg(F.collect_list("line_no").alias("gone"))
    k1, k2 = row_keys(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    joined = docs.select(F.struct("*").alias("row"), k1.alias("k1"), k2.alias("k2")).join(lists, ["k1", "k2"], "left")  # a struct: names of docs meet none of these
    text = F.col("row")[text_col].cast("string")
    parts = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    picked = F.transform(F.array(parts), lambda lines: F.transform(stay, lambda i: F.get(lines, i)))[0]  # splits the text once
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(picked, "\n"))
    removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    return joined.select(*[(kept if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c.lower() != "lines_removed"], removed.alias("lines_removed"))
