"""The build queue's event stream with Structured Streaming: parse, filter, deduplicate, trigger, lease.

The stream this engine re-expresses remembers the last 256 event ids. Here ids are remembered for a span of event
time instead, which a watermark bounds: state is dropped by age, however many events there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.text import filled

#: The shape of a change event.
EVENT = (
    "header struct<event_id: string, event_type: string>, event struct<file_token: string, file_type: string, table_id: string, "
    "action_list: array<struct<action: string, after_value: array<struct<field_id: string, field_value: string>>>>>"
)


def parsed(lines: DataFrame, schema: str = EVENT, col: str = "value") -> DataFrame:
    """The events of JSON lines; other columns stay; lines that are not JSON objects are dropped."""
    df = lines.withColumn("__e", F.from_json(col, schema)).where(F.col("__e").isNotNull() & F.trim(col).startswith("{"))
    return df.select(*[c for c in lines.columns if c != col], "__e.*")


def field_is_true(c: Column) -> Column:
    """A field's value, JSON text: true, a number other than zero, a true word, or a list that holds one."""
    bare = F.lower(F.trim(F.translate(F.coalesce(c, F.lit("")), '[]"', "   ")))
    words = F.transform(F.split(bare, ","), lambda w: F.trim(w))
    return F.exists(words, lambda w: w.isin("true", "1", "yes", "y") | F.coalesce(w.try_cast("double") != 0, F.lit(False)))


def asks_for_build(event_type: str, file_type: str, file_token: str, table_id: str, field_id: str) -> Column:
    """Whether an event is an addition or edit that sets the field that asks for a build at once."""
    same = lambda c, v: F.trim(F.coalesce(F.col(c), F.lit(""))) == v
    where = same("header.event_type", event_type) & same("event.file_type", file_type) & same("event.file_token", file_token) & same("event.table_id", table_id)
    hit = F.exists(
        F.coalesce("event.action_list", F.array()),
        lambda a: a["action"].isin("record_added", "record_edited") & F.exists(F.coalesce(a["after_value"], F.array()), lambda v: (F.trim(v["field_id"]) == field_id) & field_is_true(v["field_value"])),
    )
    return where & F.coalesce(hit, F.lit(False))


def deduplicated(events: DataFrame, id_col: str, time_col: str, within: str = "1 hour") -> DataFrame:
    """Each id once within a span of event time; events without an id all pass. Streams and tables alike."""
    named = events.where(filled(id_col).isNotNull() if dict(events.dtypes)[id_col] == "string" else F.col(id_col).isNotNull())
    rest = events.where(filled(id_col).isNull() if dict(events.dtypes)[id_col] == "string" else F.col(id_col).isNull())
    once = named.withWatermark(time_col, within).dropDuplicatesWithinWatermark([id_col]) if events.isStreaming else named.dropDuplicates([id_col])
    return once.unionByName(rest.withWatermark(time_col, within) if events.isStreaming else rest)


def on_batch(stream: DataFrame, build: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False):  # noqa: ANN201
    """Run build for each micro-batch that has rows: requests that come in meanwhile wait for the next, in one run."""

    def single(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            build(batch, number)

    writer = stream.writeStream.foreachBatch(single).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


_GRANT = "record_id string, token string, at timestamp, granted boolean, expires timestamp"


def leases(requests: DataFrame, hours: float = 2.0) -> DataFrame:
    """(record_id, token, at, granted, expires) for a stream of requests (record_id, token, at timestamp).

    A record goes to the first asker; the same token renews; another gets it only once the lease has ended (strictly).
    State is one lease per record and is dropped when the watermark passes its end.
    """
    span = pd.Timedelta(hours=hours)

    def run(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        token, until = state.get if state.exists else ("", 0)
        end = pd.Timestamp(until, unit="ms")
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["at", "token"], kind="stable")
        out = []
        for t, at in zip(rows["token"], rows["at"], strict=True):
            ok = t == token or at >= end
            if ok:
                token, end = t, at + span
            out.append((key[0], t, at, ok, end))
        until = int(end.timestamp() * 1000)
        state.update((token, until))
        now = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(until, now + 1))
        yield pd.DataFrame(out, columns=["record_id", "token", "at", "granted", "expires"])

    marked = requests.withWatermark("at", "10 minutes")
    return marked.groupBy("record_id").applyInPandasWithState(run, _GRANT, "token string, until long", "append", GroupStateTimeout.EventTimeTimeout)


_CONTEXT = "conversation string, at timestamp, events string"


def contexts(messages: DataFrame, keep: int = 20, hours: float = 24.0) -> DataFrame:
    """(conversation, at, events) for a stream (conversation, at, text): after each batch the last `keep` texts of a
    conversation, joined by line breaks; what a conversation said is forgotten after some hours without a message."""
    span = int(hours * 3_600_000)

    def run(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches), ignore_index=True).sort_values("at", kind="stable")
        held = (held + rows["text"].fillna("").tolist())[-keep:]
        last = rows["at"].iloc[-1]
        state.update((held,))
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000) + span, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], last, "\n".join(held))], columns=["conversation", "at", "events"])

    marked = messages.withWatermark("at", "10 minutes")
    return marked.groupBy("conversation").applyInPandasWithState(run, _CONTEXT, "held array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def utc_now() -> Column:
    return F.lit(datetime.now(UTC))
