"""Differences between versions and the plans that follow from them: ratchets, keyed and sequence diffs, upserts,
approval gates, guarded writes, overlays, parity, trees."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import collapsed, filled, inline_norm
from tessera.operators import align


def ratchet(now: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, state): new, known or stale for each distinct key of either side; one shuffle, repeats do not matter."""
    both = now.select(*keys, F.lit(1).alias("n"), F.lit(0).alias("b")).unionByName(before.select(*keys, F.lit(0).alias("n"), F.lit(1).alias("b")))
    seen = both.groupBy(*keys).agg(F.max("n").alias("n"), F.max("b").alias("b"))
    return seen.select(*keys, F.when(F.col("n") > F.col("b"), "new").when(F.col("n") < F.col("b"), "stale").otherwise("known").alias("state"))


def missing_and_extra(reference: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, side): reference keys that the candidate lacks ('missing') and candidate keys of its own ('extra')."""
    states = ratchet(candidate, reference, keys)
    return states.where("state <> 'known'").select(*keys, F.when(F.col("state") == "new", "extra").otherwise("missing").alias("side"))


def missing_pairs(left: DataFrame, right: DataFrame, present: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b): pairs of the distinct values of two small sets that `present` lacks.

    The right set is aggregated to one array, so its distinct values have to be few (languages, regions).
    """
    others = right.where(F.col(b).isNotNull()).agg(F.array_sort(F.collect_set(b)))
    wanted = left.where(F.col(a).isNotNull()).select(a).distinct().withColumn("__all", others.scalar()).select(a, F.explode("__all").alias(b))
    return wanted.join(present.select(a, b).distinct(), [a, b], "left_anti")


def keyed_diff(old: DataFrame, new: DataFrame, scope: Sequence[str], key: str, source: str, value: str, pos: str = "pos") -> DataFrame:
    """(scope, kind, key, old_value, new_value, how): what was added (A), modified (M) or deleted (D).

    Entries pair in four passes, each over what the last left: same key by occurrence; same source row by
    occurrence; by position in the scope if as many are left on both sides; the rest are D and A. A pair with equal
    key and value is no change; a pair whose keys differ is one M, its key written 'old -> new'. Both sides:
    scope columns, key, source (blank where unknown), value, pos (unique in scope).
    """
    o = old.select(*scope, F.col(key).alias("ok"), F.col(source).alias("os"), F.col(value).alias("ov"), F.col(pos).alias("op"))
    n = new.select(*scope, F.col(key).alias("nk"), F.col(source).alias("ns"), F.col(value).alias("nv"), F.col(pos).alias("np"))
    own, other = ["ok", "os", "ov", "op"], ["nk", "ns", "nv", "np"]

    def laid(o: DataFrame, n: DataFrame, by_o: str | None, by_n: str | None, whole: bool = False) -> DataFrame:
        """Both sides by scope, key and occurrence (whole: and number of rows in the scope), with what finds no partner."""

        def numbered(df: DataFrame, by: str | None, pos: str) -> DataFrame:
            part = [*scope, by] if by else list(scope)
            total = F.count("*").over(W.partitionBy(*scope)) if whole else F.lit(0)
            return df.withColumn("__k", F.col(by) if by else F.lit("")).withColumn("__o", F.row_number().over(W.partitionBy(*part).orderBy(pos))).withColumn("__c", total)

        return numbered(o, by_o, "op").join(numbered(n, by_n, "np"), [*scope, "__k", "__o", "__c"], "full").select(*scope, *own, *other)

    left = lambda df: df.where("np is null").select(*scope, *own)
    right = lambda df: df.where("op is null").select(*scope, *other)
    first = laid(o, n, "ok", "nk")
    named = lambda c: F.coalesce(filled(c).isNotNull(), F.lit(False))
    second = laid(left(first).where(named("os")), right(first).where(named("ns")), "os", "ns")
    third = laid(left(first).where(~named("os")).unionByName(left(second)), right(first).where(~named("ns")).unionByName(right(second)), None, None, whole=True)
    o3, n3 = left(third), right(third)
    both = lambda df, how: df.where("op is not null and np is not null").withColumn("how", F.lit(how))
    pairs = both(first, "key").unionByName(both(second, "source")).unionByName(both(third, "position"))
    changed = pairs.where(~(F.col("ok").eqNullSafe(F.col("nk")) & F.col("ov").eqNullSafe(F.col("nv"))))
    label = F.when(F.col("ok").eqNullSafe(F.col("nk")), F.col("ok")).otherwise(F.concat_ws(" -> ", "ok", "nk"))
    none = F.lit(None).cast("string")
    modified = changed.select(*scope, F.lit("M").alias("kind"), label.alias(key), F.col("ov").alias("old_value"), F.col("nv").alias("new_value"), "how")
    deleted = o3.select(*scope, F.lit("D").alias("kind"), F.col("ok").alias(key), F.col("ov").alias("old_value"), none.alias("new_value"), F.lit("left").alias("how"))
    added = n3.select(*scope, F.lit("A").alias("kind"), F.col("nk").alias(key), none.alias("old_value"), F.col("nv").alias("new_value"), F.lit("left").alias("how"))
    return modified.unionByName(deleted).unionByName(added)


def _first(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min_by(whole, pos).alias("r"), F.count("*").alias("copies")).select("r.*", "copies")


def upsert_plan(target: DataFrame, seed: DataFrame, keys: Sequence[str], fields: Sequence[str], pos: str = "pos", prune: bool = False) -> DataFrame:
    """(keys, action, changed, duplicate): create, update, skip or extra (prune, if asked for) by key.

    Keys compare with white space collapsed. In the target the first of a repeated key counts and is marked duplicate;
    in the seed the first counts; a wholly blank seed key is left out, and a blank seed cell never clears a value.
    """
    norm = lambda df: df.select(*[collapsed(k).alias(k) for k in keys], *[collapsed(f).alias(f) for f in fields], pos)
    t = _first(norm(target), keys, pos).withColumnsRenamed({f: f"t_{f}" for f in fields}).drop(pos).withColumn("in_t", F.lit(True))
    some = reduce(lambda a, b: a | b, [F.col(k) != "" for k in keys])
    s = _first(norm(seed).where(some), keys, pos).drop(pos, "copies").withColumn("in_s", F.lit(True))
    both = t.join(s, list(keys), "full")
    diffs = F.filter(F.array(*[F.when((F.col(f) != "") & ~F.col(f).eqNullSafe(F.col(f"t_{f}")), F.lit(f)) for f in fields]), lambda f: f.isNotNull())
    changed = F.when(F.col("in_t") & F.col("in_s"), F.array_join(diffs, ",")).otherwise("")
    action = F.when(F.col("in_t").isNull(), "create").when(F.col("in_s").isNull(), "prune" if prune else "extra").when(changed != "", "update").otherwise("skip")
    return both.select(*keys, action.alias("action"), changed.alias("changed"), F.coalesce(F.col("copies") > 1, F.lit(False)).alias("duplicate"))


def gate_stack(requests: DataFrame, approved: DataFrame, pos: str = "pos") -> DataFrame:
    """requests with action (apply or skip) and the reason of the first gate that holds one back.

    In order: a later request of the same hash, not approved, not resolved to one record, no table or field, no
    value. The repeat test comes first, so a later approved copy is skipped too; requests without a hash never repeat.
    requests: delta_hash, resolution_status, record_id, table, field, new_value, pos. approved: delta_hash.
    """
    firsts = requests.where(filled("delta_hash").isNotNull()).groupBy("delta_hash").agg(F.min(pos).alias("__first"))
    yes = approved.where(filled("delta_hash").isNotNull()).select("delta_hash").distinct().withColumn("__ok", F.lit(True))
    joined = requests.join(firsts, "delta_hash", "left").join(yes, "delta_hash", "left")
    reason = (
        F.when(F.col(pos) > F.col("__first"), "duplicate")
        .when(F.col("__ok").isNull(), "not_approved")
        .when((F.coalesce("resolution_status", F.lit("")) != "resolved") | filled("record_id").isNull(), "not_resolved")
        .when(filled("table").isNull() | filled("field").isNull(), "no_field")
        .when(F.coalesce("new_value", F.lit("")) == "", "no_value")
    )
    return joined.withColumn("reason", reason).withColumn("action", F.when(F.col("reason").isNull(), "apply").otherwise("skip")).drop("__first", "__ok")


def guarded_writes(plan: DataFrame, live: DataFrame) -> DataFrame:
    """plan rows to apply with `status` against the live cells: already_applied, drift_abstained, write or error.

    Each is judged alone: a cell that holds the new value is done; one that holds neither that nor the old value was
    changed by someone else; a cell that is not there is an error. plan: record_id, table, field, old_value, new_value,
    action; live: table, record_id, field, current (one row per cell).
    """
    joined = plan.where("action = 'apply'").join(live.withColumn("__there", F.lit(True)), ["table", "record_id", "field"], "left")
    now = collapsed("current")
    status = (
        F.when(F.col("__there").isNull(), "error")
        .when(now == collapsed("new_value"), "already_applied")
        .when(F.col("old_value").isNotNull() & (now != collapsed("old_value")), "drift_abstained")
        .otherwise("write")
    )
    return joined.withColumn("status", status).drop("__there")


def written_value(old: Column, new: Column, matched: Column, old_cells: Column, new_cells: Column) -> Column:
    """The new value of the cell that held `matched`: the whole new text if it was the whole old one, else the one cell
    at whose place it stood and that changed; null where that is not certain."""
    goal = collapsed(matched)
    pairs = F.filter(F.arrays_zip(old_cells.alias("o"), new_cells.alias("n")), lambda p: (p["o"] == goal) & (p["o"] != p["n"]))
    aligned = (F.size(old_cells) == F.size(new_cells)) & (F.size(pairs) == 1)
    return F.when(goal == "", F.lit(None)).when(collapsed(old) == goal, collapsed(new)).when(aligned, F.element_at(pairs, 1)["n"])


def fresh_findings(findings: DataFrame, known: DataFrame, hash_col: str = "finding_hash", pos: str = "pos") -> DataFrame:
    """Findings not stored yet, the first of each hash; those without a hash are left out."""
    return _first(findings.where(filled(hash_col).isNotNull()), [hash_col], pos).drop("copies").join(known.select(hash_col).distinct(), hash_col, "left_anti").select(*findings.columns)


def overlay(base: DataFrame, patch: DataFrame, key: str, owned: Sequence[str], pos: str = "pos") -> DataFrame:
    """base with its owned columns taken from patch where the key is there, in base's order; patch's other keys follow,
    sorted by key. Columns that patch does not own stay as they are (null in rows it adds). Adds `place`."""
    one = patch.groupBy(key).agg(*[F.first(c).alias(f"__{c}") for c in owned]).withColumn("__in", F.lit(True))
    merged = base.join(one, key, "left").select(key, *[F.when(F.col("__in"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in owned else F.col(c) for c in base.columns if c != key], F.struct(F.lit(0).alias("part"), F.col(pos).cast("string").alias("k")).alias("__s"), F.col(pos).alias("__p"))
    extra = one.join(base.select(key), key, "left_anti").select(key, *[F.col(f"__{c}").alias(c) if c in owned else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns if c != key], F.struct(F.lit(1).alias("part"), F.col(key).cast("string").alias("k")).alias("__s"), F.lit(None).cast(base.schema[pos].dataType).alias("__p"))
    order = ("__s.part", "__p", "__s.k")
    return merged.unionByName(extra).orderBy(*order).drop("__s", "__p")


def tree_overlay(bundle: DataFrame, review: DataFrame, key: str = "path") -> DataFrame:
    """Files of two trees by path; the review's copy wins. Adds `origin`."""
    r = review.withColumn("__r", F.lit(True)).withColumnsRenamed({c: f"__{c}" for c in bundle.columns if c != key})
    joined = bundle.withColumn("__b", F.lit(True)).join(r, key, "full")
    cols = [F.when(F.col("__r"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in bundle.columns if c != key]
    return joined.select(key, *cols, F.when(F.col("__r"), "review").otherwise("bundle").alias("origin"))


def schema_parity(source: DataFrame, target: DataFrame, renames: dict[str, str] | None = None, ignored: Sequence[str] = ()) -> DataFrame:
    """(table, field, state): match, missing, extra or type for two lists of (table, field, type).

    renames maps source to target field names; ignored fields are left out of both."""
    s = source.where(~F.col("field").isin(*ignored)) if ignored else source
    t = target.where(~F.col("field").isin(*ignored)) if ignored else target
    if renames:
        s = s.withColumn("field", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in renames.items() for x in kv]), F.col("field")), F.col("field")))
    both = s.select("table", "field", F.col("type").alias("s")).join(t.select("table", "field", F.col("type").alias("t")), ["table", "field"], "full")
    return both.select("table", "field", F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").when(F.col("s") != F.col("t"), "type").otherwise("match").alias("state"))


def token_symmetric_difference(df: DataFrame, keys: Sequence[str], side: Column, tokens: Column) -> DataFrame:
    """(keys, token, only_in): tokens that only one of the two sides ('a', 'b') of a key has."""
    each = df.select(*keys, side.alias("__s"), F.explode(tokens).alias("token")).where("__s in ('a', 'b')")
    seen = each.groupBy(*keys, "token").agg(F.min("__s").alias("lo"), F.max("__s").alias("hi"))
    return seen.where("lo = hi").select(*keys, "token", F.col("lo").alias("only_in"))


def block_diff(old: DataFrame, new: DataFrame, key: str, text: str, pos: str) -> DataFrame:
    """The sequence diff of two versions of a document's blocks by a minimal edit script, per key, with the neighbouring new blocks.

    Blocks compare by inline_norm, so that markup alone is no change. Keys only on one side are all inserts or all deletes.
    """
    return align.block_diff(old, new, key, text, pos, inline_norm(text))


def tree_paths(df: DataFrame, key: str, tree: str) -> DataFrame:
    """(key, path, value): a JSON tree's leaves by JSON Pointer; empty objects and arrays are leaves. A text that is no
    JSON, or is nested too deep for the parser, is one leaf at the root, a string; a null tree has no leaves."""

    def read(text: str) -> object:
        try:
            return json.loads(text)
        except (ValueError, RecursionError):
            return text

    def leaves(node: object) -> Iterator[tuple[str, str]]:
        open_ = [(node, "")]
        while open_:
            node, path = open_.pop()
            if node and isinstance(node, (dict, list)):
                below = node.items() if isinstance(node, dict) else enumerate(node)
                open_ += [(v, f"{path}/{str(k).replace('~', '~0').replace('/', '~1')}") for k, v in below]
            else:
                yield path, json.dumps(node, ensure_ascii=False, sort_keys=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, p, v) for k, t in zip(b["key"], b["tree"], strict=True) if t is not None for p, v in leaves(read(t))]
            yield pd.DataFrame(rows, columns=["key", "path", "value"])

    return df.select(F.col(key).cast("string").alias("key"), F.col(tree).alias("tree")).mapInPandas(run, "key string, path string, value string")


def tree_diff(old: DataFrame, new: DataFrame, key: str, tree: str) -> DataFrame:
    """(key, op, path, value): add, remove and replace of leaves that turn the old tree into the new one."""
    a, b = tree_paths(old, key, tree).withColumnRenamed("value", "o"), tree_paths(new, key, tree).withColumnRenamed("value", "n")
    both = a.join(b, ["key", "path"], "full").where(~F.col("o").eqNullSafe(F.col("n")))
    return both.select("key", F.when(F.col("o").isNull(), "add").when(F.col("n").isNull(), "remove").otherwise("replace").alias("op"), "path", F.col("n").alias("value"))


def tree_apply(old: DataFrame, changes: DataFrame, key: str, tree: str) -> DataFrame:
    """(key, path, value): the leaves of the old tree after the changes; equals tree_paths of the new tree."""
    kept = tree_paths(old, key, tree).join(changes.select("key", "path"), ["key", "path"], "left_anti")
    return kept.unionByName(changes.where("op <> 'remove'").select("key", "path", "value"))


def only_intended(before: DataFrame, after: DataFrame, intended: DataFrame) -> DataFrame:
    """Rows that changed between two builds but were not meant to (`unintended`) or were meant to and did not (`lost`).

    before and after have the same columns; intended is the multiset of rows that should be new."""
    made = after.exceptAll(before)
    return made.exceptAll(intended).withColumn("gate", F.lit("unintended")).unionByName(intended.exceptAll(made).withColumn("gate", F.lit("lost")))


def merged_edits(base: DataFrame, source: DataFrame, review: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, origin): a three-way merge by key: what the reviewer changed stays, the rest follows the source.

    A key that the source dropped goes unless the reviewer edited it; one that only the reviewer has stays."""
    side = lambda df, name: df.groupBy(key).agg(F.min(value).alias(name), F.lit(True).alias(f"in_{name}"))
    all_ = side(base, "b").join(side(source, "s"), key, "full").join(side(review, "r"), key, "full")
    edited = F.coalesce("in_r", F.lit(False)) & ~F.col("r").eqNullSafe(F.col("b"))
    dropped = F.coalesce("in_b", F.lit(False)) & F.col("in_r").isNull()
    kept = all_.where(edited | (F.coalesce("in_s", F.lit(False)) & ~dropped))
    return kept.select(key, F.when(edited, F.col("r")).otherwise(F.col("s")).alias(value), F.when(edited, "review").otherwise("source").alias("origin"))


def routed_edits(edits: DataFrame) -> DataFrame:
    """edits with `target`: source_table for a change in the source language, translation_memory for one in another.

    edits: lang, source_lang."""
    same = F.lower(F.trim("lang")) == F.lower(F.trim("source_lang"))
    return edits.withColumn("target", F.when(F.coalesce(same, F.lit(True)), "source_table").otherwise("translation_memory"))


def verified(now: DataFrame, frozen: DataFrame) -> DataFrame:
    """(path, state) of files against a frozen inventory (path, sha256): missing, added or changed; none if all agree."""
    both = now.select("path", F.col("sha256").alias("n")).join(frozen.select("path", F.col("sha256").alias("f")), "path", "full").where(~F.col("n").eqNullSafe(F.col("f")))
    return both.select("path", F.when(F.col("n").isNull(), "missing").when(F.col("f").isNull(), "added").otherwise("changed").alias("state"))
