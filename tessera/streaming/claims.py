"""Keyed state with order and expiry: claims of event ids, first in first out, and requests that wait for a confirmation.

Each is a stateful processor over a key's list and value state with timers. Events of a key are taken in order of
event time, then of their id. The session needs the RocksDB state store (session.session sets it; see STATE_STORE).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: What the session has to set for these processors.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _in_order(batches: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(batches), ignore_index=True).sort_values(by, kind="stable")


class _Claims(StatefulProcessor):
    """The last `most` ids of a scope, in the order in which they were first seen."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ids = handle.getListState("ids", "id string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        order = deque(r[0] for r in self.ids.get()) if self.ids.exists() else deque()
        held, out, claimed = set(order), [], False
        for i, at in _in_order(rows, ["at", "id"])[["id", "at"]].itertuples(index=False):
            new = not i or i not in held
            if new and i:
                order.append(i)
                held.add(i)
                claimed = True
                if len(order) > self.most:
                    held.discard(order.popleft())
            out.append((key[0], i, at, new))
        if claimed:
            self.ids.put([(i,) for i in order])
        yield pd.DataFrame(out, columns=["scope", "id", "at", "claimed"])

    def close(self) -> None:
        pass


def claims(events: DataFrame, most: int = 500) -> DataFrame:
    """(scope, id, at, claimed) for a stream (scope, id, at timestamp): whether an event is the first of its id among the last `most` ids of its scope.

    The oldest id is forgotten when one more comes in, so an id can be claimed again after `most` others. An event without an id
    (null or empty) is always claimed and not remembered. State is at most `most` ids a scope, whatever the stream's length.
    """
    named = events.select("scope", F.coalesce("id", F.lit("")).alias("id"), "at")
    return named.groupBy("scope").transformWithStateInPandas(_Claims(most), "scope string, id string, at timestamp, claimed boolean", "Append", "None")


def first_seen(events: DataFrame, most: int = 256) -> DataFrame:
    """The events (scope, id, at) that are the first of their id among the last `most` of their scope."""
    return claims(events, most).where("claimed").drop("claimed")


class _Pending(StatefulProcessor):
    """What one sender's last request waits for, until it is confirmed, cleared or over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "payload string, expires long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # a call of the state is a round trip, and most keys have few rows in a batch: as few calls as will do, and no frames for sorting
        was = self.held.get()
        held, out = was, []
        took = [r for b in rows for r in zip(b["at"], b["order"], b["kind"], b["payload"], b["ttl"], strict=True)]
        for at, _, kind, payload, ttl in sorted(took, key=lambda r: r[:2]):
            now = int(at.timestamp() * 1000)
            if kind == "remember":
                held = (payload or "", now + int(ttl * 1000))
            elif kind == "consume":
                live = held is not None and held[1] > now
                out.append((key[0], key[1], at, live, held[0] if live else None))
                held = None
            elif kind == "clear":
                held = None
        if was is not None and (held is None or held[1] != was[1]):
            self.handle.deleteTimer(was[1])
        if held is not None and held is not was:
            self.held.update(tuple(held))
            if was is None or held[1] != was[1]:
                self.handle.registerTimer(held[1])
        elif held is None and was is not None:
            self.held.clear()
        if out:
            yield pd.DataFrame(out, columns=["chat_id", "sender_id", "at", "matched", "payload"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.held.clear()
        yield pd.DataFrame([], columns=["chat_id", "sender_id", "at", "matched", "payload"]).astype({"at": "datetime64[us]", "matched": "bool"})

    def close(self) -> None:
        pass


def pending(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(chat_id, sender_id, at, matched, payload), a row for each `consume` of a stream (chat_id, sender_id, at timestamp, kind, payload, ttl seconds).

    `remember` keeps a payload for a chat's sender for ttl seconds and replaces the one before; `consume` takes it, once, if it is
    not over yet (strictly); `clear` drops it. Rows at one time go in that order of kinds: remember, consume, clear. State is one payload a sender and
    is dropped by a timer when the watermark passes its end.
    """
    rank = F.array_position(F.array(F.lit("remember"), F.lit("consume"), F.lit("clear")), F.col("kind")).alias("order")
    named = events.select(F.coalesce("chat_id", F.lit("")).alias("chat_id"), F.coalesce("sender_id", F.lit("")).alias("sender_id"), "at", "kind", "payload", F.coalesce(F.col("ttl").cast("double"), F.lit(0.0)).alias("ttl"), rank)
    marked = named.withWatermark("at", late)
    return marked.groupBy("chat_id", "sender_id").transformWithStateInPandas(_Pending(), "chat_id string, sender_id string, at timestamp, matched boolean, payload string", "Append", "EventTime")


class _Contexts(StatefulProcessor):
    """The last `keep` messages of a sender in a chat, forgotten `ttl` after the last of them."""

    def __init__(self, keep: int, ttl: timedelta):
        self.keep, self.ttl = keep, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.texts = handle.getListState("texts", "text string, at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = [tuple(r) for r in self.texts.get()] if self.texts.exists() else []
        span, out = int(self.ttl.total_seconds() * 1000), []
        for text, at in _in_order(rows, ["at", "text"])[["text", "at"]].itertuples(index=False):
            now = int(pd.Timestamp(at).timestamp() * 1000)
            if held and held[-1][1] + span <= now:
                held = []
            held = [*held, (text, now)][-self.keep :]
            out.append((key[0], key[1], at, [t for t, _ in held]))
        self.texts.put(held)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(held[-1][1] + span)
        yield pd.DataFrame(out, columns=["chat_id", "sender_id", "at", "texts"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.texts.clear()
        yield pd.DataFrame([], columns=["chat_id", "sender_id", "at", "texts"]).astype({"at": "datetime64[us]"})

    def close(self) -> None:
        pass


def conversations(messages: DataFrame, keep: int = 20, ttl: timedelta = timedelta(hours=24), late: str = "10 minutes") -> DataFrame:
    """(chat_id, sender_id, at, texts) for each message of a stream (chat_id, sender_id, at timestamp, text): what its sender last said there, itself included.

    At most `keep` texts; all are forgotten once `ttl` has passed since the last. Null texts are empty.
    """
    named = messages.select(F.coalesce("chat_id", F.lit("")).alias("chat_id"), F.coalesce("sender_id", F.lit("")).alias("sender_id"), "at", F.coalesce("text", F.lit("")).alias("text"))
    return named.withWatermark("at", late).groupBy("chat_id", "sender_id").transformWithStateInPandas(_Contexts(keep, ttl), "chat_id string, sender_id string, at timestamp, texts array<string>", "Append", "EventTime")
