"""A live log of events as a streaming source: numbered lines of a server, read by ranges of numbers.

Offsets are sequence numbers, so Spark can ask for a range again: after a crash the range of the batch that was open is
read anew from the server, and what was committed is never asked for again.
"""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tessera.sources.remote import Retry, fetched


@dataclass
class Span(InputPartition):
    start: int
    stop: int


class EventLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.first = options["url"], int(options.get("start", "0"))
        self.limit, self.per = int(options.get("pageSize", "200")), int(options.get("eventsPerPartition", "2000"))
        self.retry = Retry(int(options.get("retries", "3")), float(options.get("retryBase", "1.0")))

    def _ask(self, start: int, limit: int) -> dict:
        return fetched(f"{self.url}?{urllib.parse.urlencode({'from': start, 'limit': limit})}", self.retry)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": self.first}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"next": max(self.first, int(self._ask(0, 0)["next"]))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["next"], end["next"]
        return [Span(a, min(a + self.per, hi)) for a in range(lo, hi, self.per)]

    def read(self, partition: Span) -> Iterator[tuple[int, str]]:
        """The span's events; a server that no longer has them all is an error, not a shorter stream."""
        at = partition.start
        while at < partition.stop:
            lines = self._ask(at, min(self.limit, partition.stop - at))["events"]
            if not lines:
                raise ValueError(f"the log lacks events from {at} to {partition.stop}")
            for line in lines:
                yield at, line if isinstance(line, str) else json.dumps(line, ensure_ascii=False)
                at += 1

    def commit(self, end: dict) -> None:
        pass


class EventLog(DataSource):
    """spark.dataSource.register(EventLog); spark.readStream.format("event_log").option("url", ...).load().

    The server answers GET url?from=n&limit=m with {"events": [...], "next": the number after its last event}. Options: url, start, pageSize,
    eventsPerPartition (a backlog is read by that many to a task), retries, retryBase. Rows are (seq, value), value being the line.
    """

    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return "seq long, value string"

    def streamReader(self, schema: object) -> DataSourceStreamReader:  # noqa: N802
        return EventLogReader(self.options)
