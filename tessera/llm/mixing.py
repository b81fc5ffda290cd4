"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

A schedule gives each source a weight at every training time t in [0, 1], as a piecewise-linear function; its
integral is the source's cumulative token demand. Inverting that demand at a document's place in its source's
supply gives the document's training position, and a range sort by position gives the training order.

Places are running sums of sizes in a source. A source can hold a third of all rows, so no window spans a
source: documents are hashed to buckets, bucket totals are summed up (a small table), and windows run only
inside (source, bucket). So can an id: rows that agree in source, id and size are counted before the windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import small, written


def words_in(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, cycle: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) for each source.

    Sources in code-point order, null last, take the weights of cycle in turn. They share `share` times all
    sizes by weight; a target stops at `most` times its source's size and the excess is reshared by weight
    until none is above. In closed form: ordered by cap per weight, the first source whose cap lies above the
    common level bounds the capped ones. One row per source is all that the windows here see.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(cycle)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), turn + 1))
    caps = weighed.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    ranked = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = ranked.rowsBetween(W.unboundedPreceding, -1), ranked.rowsBetween(0, W.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = caps.withColumn("level", level)
    common = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(W.partitionBy())["level"]
    free = F.coalesce(common, F.lit(float("inf"))) * F.col("weight")
    return levels.withColumn("target", F.least("cap", free)).select("source", "source_size", "weight", "target")


def placed(docs: DataFrame, chunk: int = 100_000) -> DataFrame:
    """(doc_id, source, size, before), a row for each row of docs: `before` is the words of its source that come
    before it, in hash order.

    The order is that of md5(doc_id), then doc_id, then size: the same on every run. Rows that tie in all three
    are interchangeable, so they are counted and placed as one, and spread again in chunks: an id that a third of
    all rows share, or that they lack, is as many rows to the windows as it has different sizes.
    """
    groups = docs.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))
    rank = F.md5(F.col("doc_id").cast("string"))
    keyed = groups.withColumn("rank", rank).withColumn("bucket", F.substring(F.coalesce("rank", F.lit("~")), 1, 4))
    sums = keyed.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("held"))
    # two levels again: buckets of the same two leading digits form a block, so that no window sees over 257 rows a source
    sums = sums.withColumn("block", F.substring("bucket", 1, 2))
    blocks = sums.groupBy("source", "block").agg(F.sum("held").alias("block_held"))
    above = blocks.withColumn("above", F.sum("block_held").over(W.partitionBy("source").orderBy("block")) - F.col("block_held"))
    inside = sums.withColumn("inside", F.sum("held").over(W.partitionBy("source", "block").orderBy("bucket")) - F.col("held"))
    starts = inside.alias("i").join(above.alias("a"), F.col("i.source").eqNullSafe(F.col("a.source")) & (F.col("i.block") == F.col("a.block")))
    starts = starts.select(F.col("i.source").alias("s_source"), F.col("i.bucket").alias("s_bucket"), (F.col("inside") + F.col("above")).alias("start"))
    order = W.partitionBy("source", "bucket").orderBy(F.col("rank").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), "size").rowsBetween(W.unboundedPreceding, 0)
    run = keyed.withColumn("within", F.sum(F.col("size") * F.col("copies")).over(order) - F.col("size") * F.col("copies"))
    joined = run.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("s_bucket")))
    parts = joined.withColumn("base", F.col("start") + F.col("within")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(chunk).cast("long"))))
    parts = parts.select("doc_id", "source", "size", "base", "part", F.least(F.lit(chunk), F.col("copies") - F.col("part")).alias("n")).repartition("source", "doc_id", "size", "part")
    each = parts.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select("doc_id", "source", "size", (F.col("base") + (F.col("part") + F.col("i")) * F.col("size")).alias("before"))


def mix_with_sources(docs: DataFrame, cycle: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(mix, sources): (doc_id, source, size, source_size, target, before, taken) by row, and targets() by source.

    A source is passed through as often as its target holds it whole; the last pass takes documents in hash
    order until the target, rounded to a word, is met, the last of them in part. So no document exceeds `most`
    times its size and each source's taken words are its target. Null source is a source; null or blank text
    has size 0 and takes 0; null doc_id comes last; an empty table gives no rows.
    """
    sized = written(docs.select(F.col("doc_id"), F.col("source"), words_in(F.col("text")).alias("size")))
    sources = written(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, share, most))
    goals = sources.select(F.col("source").alias("t_source"), "source_size", "target")
    joined = placed(sized).join(F.broadcast(goals) if small(goals) else goals, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    goal = F.round("target").cast("long")
    whole = F.floor(goal / F.greatest("source_size", F.lit(1))).cast("long")
    rest = goal - whole * F.col("source_size") - F.col("before")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least("size", rest))
    return joined.withColumn("taken", taken.cast("long")).select("doc_id", "source", "size", "source_size", "target", "before", "taken"), sources


def curriculum(mixed: DataFrame, schedules: DataFrame) -> DataFrame:
    """Training positions for the rows of mix(): adds `position` (0 to 1) and sorts by it.

    schedules: (source, t0, t1, w0, w1) pieces, by source without gaps over [0, 1]; the weight runs from w0 to w1.
    The share of a source's demand met by time t is the integral of its weight up to t over the whole integral;
    a document whose taken words start at share q gets the t at which that much is met. Sources with no
    schedule get a constant weight, so that position is the share itself. Rows that take no word have no position.
    """
    area = schedules.withColumn("area", (F.col("t1") - F.col("t0")) * (F.col("w0") + F.col("w1")) / 2)
    by = W.partitionBy("source").orderBy("t0")
    part = area.withColumn("till", F.sum("area").over(by)).withColumn("all", F.sum("area").over(W.partitionBy("source")))
    part = part.where("area > 0").select(F.col("source").alias("p_source"), "t0", "t1", "w0", "w1", ((F.col("till") - F.col("area")) / F.col("all")).alias("q0"), (F.col("till") / F.col("all")).alias("q1"), F.col("all").alias("p_all"))
    share = F.when(F.col("source_size") > 0, F.col("before") / F.col("source_size"))
    asked = mixed.withColumn("q", share)
    met = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("q") >= F.col("q0")) & (F.col("q") < F.col("q1"))
    found = asked.join(F.broadcast(part) if small(schedules) else part, met, "left")
    need = (F.col("q") - F.col("q0")) * F.col("p_all")  # area to gather after t0: w0 x + slope x^2 / 2
    slope = (F.col("w1") - F.col("w0")) / (F.col("t1") - F.col("t0"))
    step = F.when(F.abs(slope) < 1e-12, need / F.col("w0")).otherwise((F.sqrt(F.greatest(F.lit(0.0), F.col("w0") * F.col("w0") + 2 * slope * need)) - F.col("w0")) / slope)
    position = F.when(F.col("taken") > 0, F.when(F.col("p_source").isNull() & F.col("p_all").isNull(), F.col("q")).otherwise(F.least(F.col("t1"), F.col("t0") + step)))
    return found.withColumn("position", position).drop("p_source", "t0", "t1", "w0", "w1", "q0", "q1", "p_all", "q").orderBy(F.col("position").asc_nulls_last(), "source", "doc_id")


def curriculum_by_pass(mixed: DataFrame, schedules: DataFrame) -> DataFrame:
    """Like curriculum(), by the words that are taken: adds `positions`, one for each pass that reads the row, and
    `position`, the first of them.

    A source's passes follow each other, so pass k reaches a row after k * source_size + before words; the position
    is the t at which that share of the source's target, rounded to a word, is asked for.
    """
    area = schedules.withColumn("area", (F.col("t1") - F.col("t0")) * (F.col("w0") + F.col("w1")) / 2)
    by = W.partitionBy("source").orderBy("t0")
    part = area.withColumn("till", F.sum("area").over(by)).withColumn("all", F.sum("area").over(W.partitionBy("source"))).where("area > 0")
    piece = F.struct("t0", "t1", "w0", "w1", ((F.col("till") - F.col("area")) / F.col("all")).alias("q0"), (F.col("till") / F.col("all")).alias("q1"), F.col("all").alias("p_all"))
    part = part.groupBy(F.col("source").alias("p_source")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.lit(True).alias("planned"))
    joined = mixed.join(F.broadcast(part) if small(schedules) else part, F.col("source").eqNullSafe(F.col("p_source")), "left")

    goal = F.round("target").cast("long")
    whole = F.floor(goal / F.greatest("source_size", F.lit(1))).cast("long")
    passes = whole + F.when(F.col("taken") > whole * F.col("size"), F.lit(1)).otherwise(F.lit(0))

    def reached(q: Column) -> Column:
        p = F.coalesce(F.get(F.filter("pieces", lambda x: q < x["q1"]), F.lit(0)), F.element_at("pieces", -1))
        need = (q - p["q0"]) * p["p_all"]
        slope = (p["w1"] - p["w0"]) / (p["t1"] - p["t0"])
        step = F.when(F.abs(slope) < 1e-12, need / p["w0"]).otherwise((F.sqrt(F.greatest(F.lit(0.0), p["w0"] * p["w0"] + 2 * slope * need)) - p["w0"]) / slope)
        return F.when(F.col("planned"), F.least(p["t1"], p["t0"] + step)).otherwise(q)

    starts = F.transform(F.sequence(F.lit(0).cast("long"), passes - 1), lambda k: (k * F.col("source_size") + F.col("before")) / goal)
    found = joined.withColumn("positions", F.when(F.col("taken") > 0, F.transform(starts, reached)))
    return found.withColumn("position", F.get("positions", F.lit(0))).select(*[c for c in mixed.columns if c not in ("position", "positions")], "position", "positions").orderBy(F.col("position").asc_nulls_last(), "source", "doc_id")


def tilted(sources: DataFrame) -> DataFrame:
    """A schedule for each (source, weight): sources in turn rise from half to one and a half times their weight, or fall so."""
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) % 2
    low, high = F.col("weight") * 0.5, F.col("weight") * 1.5
    return sources.select("source", F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1"), F.when(turn == 1, low).otherwise(high).alias("w0"), F.when(turn == 1, high).otherwise(low).alias("w1"))
