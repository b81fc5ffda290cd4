"""A Merkle manifest of a table: a hash tree for each group of rows, a tree over the groups, and a proof for each row.

A leaf is the SHA-256 of a row's fields. Leaves stand in order within their group; every `fanout` consecutive nodes
become the hash of their digests, until one is left, the group's subroot. The subroots, in order of the groups, give
the root in the same way. A row's proof lists the siblings on its way up, so the root can be computed again from the
row alone.

A level is a window: partitioned by group and parent index, an ordered full-frame collect_list is the parent's
preimage and holds the siblings. Only the first node of a run carries the parent on, so that each parent stands once in
the next level. `band` levels at a time run on rows that are dealt by (group, index // fanout ** band), one
shuffle in all and at most fanout ** band rows in a window; what remains of a band, a fanout ** band-th of the rows,
is the next band's table. Places in a group are counted by range partitions, so a group of any size spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import small, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: dict[str, Column]) -> Column:
    """SHA-256, lowercase hex, of the fields in turn: `-` for null, else UTF-8 byte count, `:`, value (numbers in decimal)."""
    texts = [c.cast("string") for c in fields.values()]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def numbered(rows: DataFrame, order: list[str], group: str = "g") -> DataFrame:
    """rows with `i`, the place (from 0) in its group by order (nulls last), and `n`, the group's number of rows. No group is null.

    Rows are cut into ranges by (group, order); rows that agree in both may stand in any of them, so a value that a third of all rows
    share is spread too. A row's place is that within its range and the rows of its group in the ranges before.
    """
    keys = [F.col(group), *[F.col(c).asc_nulls_last() for c in order]]
    dealt = rows.withColumn("m", F.spark_partition_id()).repartitionByRange(*keys, "m").sortWithinPartitions(*keys)
    laid = written(dealt.drop("m").withColumn("m", F.monotonically_increasing_id()))  # range, and place within it
    laid = laid.withColumn("part", F.shiftright("m", 33))
    held = laid.groupBy(group, "part").agg(F.min("m").alias("m0"), F.count("*").alias("c"))
    upto = W.partitionBy(group).orderBy("part")  # a row for each range that holds some of the group
    starts = written(held.select(group, "part", (F.sum("c").over(upto) - F.col("c") - F.col("m0")).alias("shift"), F.sum("c").over(W.partitionBy(group)).alias("n")))
    placed = laid.join(F.broadcast(starts) if small(starts) else starts, [group, "part"])
    return placed.withColumn("i", F.col("m") + F.col("shift")).drop("m", "part", "shift")


def _band(nodes: DataFrame, fanout: int, band: int) -> tuple[DataFrame, DataFrame]:
    """(paths, tops) of `band` levels over nodes (g, i, n, h, ...): nodes with `block` and `path`, array of <l, r> hex left and
    right of the node on each level; and (g, i, n, h), the nodes that remain, of n a group."""
    size = fanout**band
    now = nodes.withColumns({"block": F.expr(f"i div {size}"), "up": F.col("h")}).repartition("g", "block")
    steps = []
    for k in range(band):
        width = fanout**k
        run = W.partitionBy("g", "block", F.expr(f"i div {width * fanout}")).orderBy("i").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        first = F.when(F.col("i") % width == 0, F.col("up"))  # one row speaks for each node
        own = F.expr(f"cast(i div {width} % {fanout} as int)")
        now = now.withColumn("run", F.collect_list(first).over(run))
        cut = lambda at, length: F.array_join(F.slice("run", at, F.greatest(length, F.lit(0))), "")
        more = F.col("n") > width
        now = now.withColumn(f"s{k}", F.when(more, F.struct(cut(F.lit(1), own).alias("l"), cut(own + 2, F.size("run") - own - 1).alias("r"))))
        now = now.withColumn("up", F.when(more, F.sha2(F.array_join("run", ""), 256)).otherwise(F.col("up"))).drop("run")
        steps.append(f"s{k}")
    paths = now.withColumn("path", F.array_compact(F.array(*steps))).drop(*steps)
    tops = paths.where(F.col("i") % size == 0).select("g", F.col("block").alias("i"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("up").alias("h"))
    return paths, tops


def tree(nodes: DataFrame, fanout: int = 3, band: int = 6) -> tuple[DataFrame, DataFrame]:
    """(paths, roots) of nodes (g, i, n, h, ...): nodes with `path` from node to root of its group, and (g, root)."""
    bands, now, size = [], nodes, fanout**band
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        paths, tops = _band(now, fanout, band)
        bands.append(paths)
        most = -(-most // size)
        if most <= 1:
            break
        now = written(tops)
    roots = written(tops.select("g", F.col("h").alias("root")))
    above = None
    for paths in reversed(bands):
        if above is not None:
            upper = above.select("g", F.col("i").alias("block"), F.col("path").alias("upper"))
            paths = paths.join(upper, ["g", "block"]).withColumn("path", F.concat("path", "upper")).drop("upper")
        above = paths
    return above.drop("block", "up"), roots


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def manifest(rows: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", fanout: int = 3, band: int = 6, checked: Column | None = None) -> DataFrame:
    """A row for each of rows: the fields `order` and `group` as they are, leaf, subroot, root, path (array of <l, r>, from leaf to root), and
    folded_root: the root that the leaf `checked` (where null: the row's own) gives with the path.

    Leaves ascend by order, then by leaf; nulls of order come last. Null is a group, the first; groups ascend by their UTF-8
    bytes. Rows that repeat are leaves each. A row with null or empty fields has a leaf like any other. Columns that are not in fields
    do not count, whatever their names. An empty table gives no rows.
    """
    own = leaf({c: F.col(c) for c in fields})
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # sorts as the groups do, null first
    leaves = rows.select(F.col(order).alias("o"), F.col(group).alias("was"), name.alias("g"), own.alias("h"), (own if checked is None else F.coalesce(checked, own)).alias("seen"))
    paths, subroots = tree(numbered(leaves, ["o", "h", "seen"]), fanout, band)
    groups = numbered(subroots.select(F.lit(0).alias("g"), F.col("g").alias("name"), F.col("root").alias("h")), ["name"])
    above, roots = tree(groups, fanout, band)
    tops = written(above.select("g", "name", F.col("h").alias("subroot"), F.col("path").alias("upper")).join(F.broadcast(roots), "g").drop("g").withColumnRenamed("name", "g"))  # roots: one row
    joined = paths.join(F.broadcast(tops) if small(tops) else tops, "g").withColumn("path", F.concat("path", "upper"))
    return joined.select(F.col("o").alias(order), F.col("was").alias(group), F.col("h").alias("leaf"), "subroot", "root", "path", fold(F.col("seen"), F.col("path")).alias("folded_root"))


def proof(path: Column) -> Column:
    """SHA-256 of the siblings, level by level from leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


def verified(rows: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS, text: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for rows whose text loses its line ends where `tampered` holds.

    All but folded_root come from the rows as they are; it is computed from the changed row's leaf and the original path.
    """
    changed = leaf({c: F.translate(text, "\n", "") if c == text else F.col(c) for c in fields})
    found = manifest(rows, fields, checked=F.when(tampered, changed))
    return found.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
