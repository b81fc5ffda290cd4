"""Counts, rates, facets, inventories and roll-ups. Every grouping combines map-side before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import collapsed, filled
from tessera.functions.values import month, rate


def monthly_counts(df: DataFrame, when: str) -> DataFrame:
    """(month, n): rows by the first seven characters of their date; null and blank dates are left out."""
    return df.select(month(when).alias("month")).where(filled("month").isNotNull()).groupBy("month").agg(F.count("*").alias("n"))


def hit_rates(runs: DataFrame, group: Sequence[str], matched: str = "units_matched", total: str = "units_total") -> DataFrame:
    """(group, runs, runs_without_counters, matched, total, hit_rate): overall (null group) and by group.

    Rows without both counters count as runs but not in the rate."""
    counted = F.col(matched).isNotNull() & F.col(total).isNotNull()
    aggs = [F.count("*").alias("runs"), F.count_if(~counted).alias("runs_without_counters"), F.sum(F.when(counted, F.col(matched))).alias("matched"), F.sum(F.when(counted, F.col(total))).alias("total")]
    rolled = runs.groupingSets([list(map(F.col, group)), []], *group).agg(F.grouping_id().alias("level"), *aggs)
    return rolled.withColumn("overall", F.col("level") > 0).drop("level").withColumn("hit_rate", rate("matched", "total"))


def ledger_statuses(rows: DataFrame) -> DataFrame:
    """(route, status, n) of a revision ledger; a blank status is pending, a blank route unknown."""
    return rows.groupBy(F.coalesce(filled("route_class"), F.lit("unknown")).alias("route"), F.coalesce(filled("final_status"), F.lit("pending")).alias("status")).agg(F.count("*").alias("n"))


# The statuses of a revision.
DECIDED = ("accepted_as_proposed", "edited_further", "rejected")
CORRECTED = ("accepted_as_proposed", "edited_further")


def ledger_rates(rows: DataFrame) -> DataFrame:
    """(route, total, pending, decided, accepted, reflow_rate, acceptance_rate) by route and overall (null route).

    reflow_rate is the share no longer pending; acceptance_rate the share of decided rows taken as proposed."""
    s = ledger_statuses(rows)
    rolled = s.groupingSets([[F.col("route")], []], "route").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("status") == "pending", F.col("n"))), F.lit(0)).alias("pending"),
        F.coalesce(F.sum(F.when(F.col("status").isin(*DECIDED), F.col("n"))), F.lit(0)).alias("decided"),
        F.coalesce(F.sum(F.when(F.col("status") == "accepted_as_proposed", F.col("n"))), F.lit(0)).alias("accepted"),
    )
    return rolled.withColumn("reflow_rate", rate(F.col("total") - F.col("pending"), "total")).withColumn("acceptance_rate", rate("accepted", "decided"))


def top_counts(df: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """(key, n): the most frequent keys, by count, then key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(limit)


def second_revision_rate(rows: DataFrame, text: str, run: str) -> DataFrame:
    """One row: texts, repeated, rate: the share of normalised texts that more than one run touched.

    Blank texts are dropped; blank runs are one run. min and max tell whether there is more than one."""
    by = rows.select(collapsed(text).alias("t"), F.coalesce(filled(run), F.lit("")).alias("r")).where("t <> ''").groupBy("t").agg((F.min("r") != F.max("r")).alias("again"))
    return by.agg(F.count("*").alias("texts"), F.count_if("again").alias("repeated")).withColumn("rate", rate("repeated", "texts"))


def facet_counts(df: DataFrame, attributes: dict[str, Column]) -> DataFrame:
    """(facet, value, n) over multi-valued attributes (array columns), each value once per row; blanks left out."""

    def pairs_of(name: str, c: Column) -> Column:
        return F.transform(F.array_distinct(c), lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))

    pairs = [pairs_of(name, c) for name, c in attributes.items()]
    each = df.select(F.explode(F.flatten(F.array(*pairs))).alias("x")).select("x.*")
    return each.where(filled("value").isNotNull()).groupBy("facet", "value").agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, key: Column, member: str) -> DataFrame:
    """(key, n, member): a row for each member of a key that has several; no list of members is built."""
    keyed = df.select(key.alias("key"), F.col(member)).where(filled("key").isNotNull())
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(many, "key").select("key", "n", member)


def exact_repeats(df: DataFrame, cols: Sequence[str], line: str) -> DataFrame:
    """(line, first_line): rows that repeat an earlier row in all cols, with the first one's line."""
    told = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]  # a hash passes over nulls
    marked = df.select(F.xxhash64(*told).alias("h1"), F.xxhash64(F.lit(1), *told).alias("h2"), F.col(line).alias("line"))
    first = marked.groupBy("h1", "h2").agg(F.min("line").alias("first_line"), F.count("*").alias("n")).where("n > 1")
    return marked.join(first, ["h1", "h2"]).where("line > first_line").select("line", "first_line")


def without_repeats(df: DataFrame, cols: Sequence[str], line: str) -> DataFrame:
    """df without the rows that repeat an earlier one in all cols."""
    return df.join(exact_repeats(df, cols, line).select(F.col("line").alias(line)), line, "left_anti")


def disjoint_value_sets(df: DataFrame, keys: Sequence[str], side: Column, value: Column) -> DataFrame:
    """Keys present on both sides ('a', 'b') whose value sets share nothing: (keys, n_a, n_b), distinct values each."""
    seen = df.select(*keys, side.alias("s"), value.alias("v")).where("s in ('a', 'b') and v is not null").groupBy(*keys, "v").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    per = seen.groupBy(*keys).agg(F.count_if(F.col("lo") == "a").alias("n_a"), F.count_if(F.col("hi") == "b").alias("n_b"), F.count_if(F.col("lo") != F.col("hi")).alias("shared"))
    return per.where("n_a > 0 and n_b > 0 and shared = 0").drop("shared")


def overview(df: DataFrame, models: Column, updated: str) -> DataFrame:
    """One row: rows, distinct_models over split cells, last_updated. Two aggregates, one as a scalar."""
    totals = df.agg(F.count("*").alias("rows"), F.max(updated).alias("last_updated"))
    kinds = df.select(F.explode(models).alias("m")).where(filled("m").isNotNull()).distinct().agg(F.count("*").alias("distinct_models"))
    return totals.select("rows", kinds.scalar().alias("distinct_models"), "last_updated")


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(dimension, n): how many distinct non-blank values each column has."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), filled(c).alias("v")) for c in cols])).alias("x")).select("x.*").where("v is not null")
    return stacked.distinct().groupBy("dimension").agg(F.count("*").alias("n"))


def outcome_rates(results: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: passed, skipped, failed, coverage (passed of all), and whether skips and fails stay within the baseline."""
    n = results.agg(*[F.count_if(F.upper("outcome") == s).alias(name) for s, name in (("PASS", "passed"), ("SKIP", "skipped"), ("FAIL", "failed"))])
    out = n.withColumn("coverage", rate("passed", F.col("passed") + F.col("skipped") + F.col("failed")))
    most = lambda c: F.coalesce(baseline.agg(F.max(c)).scalar(), F.lit(0))
    return out.withColumn("skip_ok", F.col("skipped") <= most("skipped")).withColumn("fail_ok", F.col("failed") <= most("failed"))


def inventory(df: DataFrame, source: str, targets: Column, shown: int = 3) -> DataFrame:
    """(target, occurrences, n_sources, sources): every target with its first sources and '+N more'.

    The sources shown are the least ones, kept by rank within (target, source) pairs; no list grows with the data.
    """
    each = df.select(F.col(source).cast("string").alias("s"), F.explode(targets).alias("target")).where(filled("target").isNotNull())
    pairs = each.groupBy("target", "s").agg(F.count("*").alias("c"))
    totals = pairs.groupBy("target").agg(F.sum("c").alias("occurrences"), F.count("*").alias("n_sources"))
    first = pairs.withColumn("r", F.row_number().over(W.partitionBy("target").orderBy("s"))).where(F.col("r") <= shown)
    listed = first.groupBy("target").agg(F.array_join(F.array_sort(F.collect_list("s")), "; ").alias("named"))
    more = F.when(F.col("n_sources") > shown, F.concat(F.lit("; +"), (F.col("n_sources") - shown).cast("string"), F.lit(" more"))).otherwise("")
    return totals.join(listed, "target").select("target", "occurrences", "n_sources", F.concat("named", more).alias("sources"))


def with_manual(found: DataFrame, manual: DataFrame) -> DataFrame:
    """An inventory with targets listed by hand: a known one gains its source but no occurrence, a new one is added with none."""
    m = manual.groupBy("target").agg(F.min("source").alias("__m"))
    joined = found.join(m, "target", "full")
    return joined.select("target", F.coalesce("occurrences", F.lit(0)).alias("occurrences"), F.concat_ws("; ", "sources", "__m").alias("sources"))


def drift_variants(entries: DataFrame) -> DataFrame:
    """(key, lang, variants, suggestion): texts with several translations; the one that leads alone is suggested.

    entries: key, lang, text."""
    n = entries.where(filled("key").isNotNull() & filled("text").isNotNull()).groupBy("key", "lang", "text").agg(F.count("*").alias("n"))
    best = n.groupBy("key", "lang").agg(F.count("*").alias("variants"), F.max("n").alias("most")).where("variants > 1")
    leaders = n.join(best, ["key", "lang"]).where("n = most").groupBy("key", "lang", "variants").agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
    return leaders.select("key", "lang", "variants", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("suggestion"))


def shared_by(df: DataFrame, line: Column, label: str) -> DataFrame:
    """(line, n_labels, shared): lines with how many labels (targets) hold them."""
    pairs = df.select(line.alias("line"), F.col(label).alias("l")).where("line <> ''").distinct()
    return pairs.groupBy("line").agg(F.count("*").alias("n_labels")).withColumn("shared", F.col("n_labels") > 1)


def page_rollup(rows: DataFrame, keys: Sequence[str], kind: str, path: str, sums: Sequence[str]) -> DataFrame:
    """(keys, n, sums, kinds, paths): a page's changes in one row, with sorted distinct kinds and paths joined.

    Kinds and paths of one page are few; the lists are per page, not per table."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(s).alias(s) for s in sums], F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds"), F.array_join(F.array_sort(F.collect_set(path)), ",").alias("paths"))


def nested_sections(rows: DataFrame, section: str, row: str, line: str, value: str) -> DataFrame:
    """(section, row, lines, text): a row's values in line order, joined; sections and rows stay flat for the sink."""
    lists = rows.groupBy(section, row).agg(F.array_sort(F.collect_list(F.struct(F.col(line).alias("l"), F.col(value).cast("string").alias("v")))).alias("x"))
    return lists.select(section, row, F.size("x").cast("long").alias("lines"), F.array_join(F.transform("x", lambda e: F.coalesce(e["v"], F.lit(""))), "|").alias("text"))


def grouped_queue(rows: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """(keys, first_pos, n, lang, force, same_version): queue rows by build, in order of first appearance.

    lang is the first non-blank one in row order, force whether any row asks for it, same_version whether all agree.
    """
    lang = F.min(F.when(filled("lang").isNotNull(), F.struct(F.col(pos).alias("p"), F.trim("lang").alias("l"))))["l"]
    return rows.groupBy(*keys).agg(F.min(pos).alias("first_pos"), F.count("*").alias("n"), lang.alias("lang"), F.bool_or(F.coalesce("force", F.lit(False))).alias("force"), F.coalesce(F.min("version") == F.max("version"), F.lit(True)).alias("same_version"))


def split_in_two(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Adds `side`: left for the first half of a key's rows (the larger one), right for the rest."""
    return df.withColumn("side", F.when(F.ntile(2).over(W.partitionBy(*keys).orderBy(*order)) == 1, "left").otherwise("right"))


def numbered_repeats(df: DataFrame, keys: Sequence[str], name: str, order: str) -> DataFrame:
    """Adds `shown`: the name, with ' #2' and so on from its second appearance."""
    n = F.row_number().over(W.partitionBy(*keys, name).orderBy(order))
    return df.withColumn("shown", F.when(n > 1, F.concat(F.col(name), F.lit(" #"), n.cast("string"))).otherwise(F.col(name)))


def capability_matrix(records: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row per document key, that of the least project, with flags as TRUE or FALSE; blank keys are dropped."""
    from tessera.functions.values import flag

    rows = records.where(filled("document_key").isNotNull()).select(F.trim("document_key").alias("document_key"), F.coalesce(F.trim("project"), F.lit("")).alias("project"), *[F.when(flag(f, "lint"), "TRUE").otherwise("FALSE").alias(f) for f in flags])
    best = rows.groupBy("document_key").agg(F.min(F.struct("project", *flags)).alias("m"))
    return best.select("document_key", "m.*")
