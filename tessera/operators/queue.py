"""The build queue as tables: what is pending, who holds it, where results stand, what to deliver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import filled
from tessera.functions.values import claim_active, flag
from tessera.operators.lookup import best_per_key


def pending(rows: DataFrame, now: Column, immediate_only: bool = False, action: str | None = None, record_ids: Sequence[str] = (), include_claimed: bool = False) -> DataFrame:
    """Queue rows to build: triggered, with an action, not leased, and immediate if asked for.

    rows: record_id, trigger, immediate, workflow_action, result."""
    df = rows.where(flag("trigger", "lint") & filled("workflow_action").isNotNull())
    if not include_claimed:
        df = df.where(~claim_active("result", now))
    if immediate_only:
        df = df.where(flag("immediate", "lint"))
    if action:
        df = df.where(F.lower(F.trim("workflow_action")) == action.strip().lower())
    return df.where(F.col("record_id").isin(*record_ids)) if record_ids else df


def blocked_groups(rows: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    """rows with `blocked`: whether any row of the group is leased. One aggregate joined back, so a large group is combined first."""
    held = rows.where(claim_active("result", now)).select(*keys).distinct().withColumn("__held", F.lit(True))
    return rows.join(held, list(keys), "left").withColumn("blocked", F.coalesce("__held", F.lit(False))).drop("__held")


def latest_state(transitions: DataFrame, key: str = "record_id", at: str = "at", pos: str = "pos") -> DataFrame:
    """The last transition of each record: append-only rows, the latest time, then the latest row."""
    return best_per_key(transitions.withColumn("__n", -F.col(pos)), [key], [F.col(at)], "__n").drop("__n")


def running_text(token: Column, expires: Column) -> Column:
    return F.concat(F.lit("RUNNING | claim_token="), token, F.lit(" | claim_expires_at="), F.date_format(expires, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def claimed(rows: DataFrame, asked: DataFrame, now: Column, ttl_hours: float = 2.0) -> DataFrame:
    """asked (record_id, token) with `granted` and the result text to write: compare-and-set against live leases; of
    several askers the least token gets the record."""
    free = rows.where(~claim_active("result", now)).select("record_id")
    best = asked.groupBy("record_id").agg(F.min("token").alias("token"))
    won = best.join(free, "record_id", "left_semi").withColumn("granted", F.lit(True))
    expires = now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_hours * 3600))
    joined = asked.join(won, ["record_id", "token"], "left").withColumn("granted", F.coalesce("granted", F.lit(False)))
    return joined.withColumn("result", F.when(F.col("granted"), running_text(F.col("token"), expires)))


def delivery(action: Column | str, url: Column | str, result: Column | str, has_baseline: Column) -> Column:
    """(kind, url, ready, baseline_missing) of a queue row: what is delivered and whether it can be."""
    a, u = F.lower(F.trim(F.col(action) if isinstance(action, str) else action)), filled(url)
    kind = F.when(a == "publish", "pdf").when(a == "web_publish", "html").when(a == "draft", "cloud_doc").otherwise("none")
    done = F.coalesce(F.lower(F.col(result) if isinstance(result, str) else result).startswith("success"), F.lit(False))
    return F.struct(kind.alias("kind"), F.coalesce(u, F.lit("")).alias("url"), ((kind != "none") & u.isNotNull() & done).alias("ready"), ((kind == "cloud_doc") & ~F.coalesce(has_baseline, F.lit(False))).alias("baseline_missing"))


def resolved_actions(requests: DataFrame, rows: DataFrame, keys: Sequence[str], confirm: Sequence[str] = ("publish", "web_publish")) -> DataFrame:
    """(request_id, record_id, status): the queue row a request means: unique, ambiguous or missing; actions in
    `confirm` need the request's `confirmed` flag, else confirm."""
    hits = requests.select("request_id", *keys).join(rows.select(*keys, "record_id"), list(keys)).groupBy("request_id").agg(F.count("*").alias("n"), F.min("record_id").alias("record_id"))
    joined = requests.join(hits, "request_id", "left")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").when(F.col("action").isin(*confirm) & ~F.coalesce("confirmed", F.lit(False)), "confirm").otherwise("unique")
    return joined.select("request_id", F.when(F.col("n") == 1, F.col("record_id")).alias("record_id"), status.alias("status"))


def matching_runs(requests: DataFrame, runs: DataFrame, slack_seconds: int = 15) -> DataFrame:
    """(request_id, run_id): the first run whose title holds the request's nonce and that began no earlier than the
    dispatch less some slack. requests: request_id, nonce, dispatched; runs: run_id, title, created.

    Nonces stand as whole words in titles, so this is an equi-join on the title's words."""
    words = runs.select("run_id", "created", "title", F.explode(F.array_distinct(F.regexp_extract_all("title", F.lit(r"[A-Za-z0-9-]+"), 0))).alias("nonce"))
    fit = requests.join(words, "nonce").where(F.col("created") >= F.col("dispatched") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(slack_seconds))))
    return fit.groupBy("request_id").agg(F.min_by("run_id", F.struct("created", "run_id")).alias("run_id"))


def with_first_in_group(rows: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """rows with `leads`: whether a row is its group's first."""
    return rows.withColumn("leads", F.row_number().over(W.partitionBy(*keys).orderBy(pos)) == 1)
