"""Writing cells of a remote table back, each checked before and after, as a Spark data source.

A row asks for one cell: record_id, field, expected (the value it should hold now; null: any), value. The cell is read first. If it
holds the value already, nothing is written, so a task that runs again writes nothing twice; if it holds anything but what is
expected, the row abstains; otherwise it is written on condition of the revision that was read, and read back. An error of one
row is its outcome and does not stop the others. What became of each row is a table of its own: tasks write
outcome files, and the commit names those of the tasks that count.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tessera.sources.remote import Retry, fetched

OUTCOME = "record_id string, field string, status string, detail string"
_COLUMNS = ("record_id", "field", "status", "detail")


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there."""
    parts = urllib.parse.urlparse(folder)
    return (pafs.LocalFileSystem(), urllib.parse.unquote(parts.path)) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(folder)


def _same(a: object, b: object) -> bool:
    bare = lambda v: "" if v is None else (v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, sort_keys=True)).strip()
    return bare(a) == bare(b)


class CellClient:
    """One cell's read, conditional write and read-back: GET url/id, PATCH url/id with fields and revision."""

    def __init__(self, url: str, retry: Retry):
        self.url, self.retry = url.rstrip("/"), retry

    def _at(self, record: str) -> str:
        return f"{self.url}/{urllib.parse.quote(record, safe='')}"

    def read(self, record: str, name: str) -> tuple[object, object]:
        found = fetched(self._at(record), self.retry)
        return (found.get("fields") or {}).get(name), found.get("revision")

    def written(self, record: str, name: str, expected: str | None, value: str | None) -> tuple[str, str]:
        """(status, detail): already_applied, drift_abstained, written, verify_failed or error."""
        try:
            for _ in range(self.retry.times + 1):
                now, revision = self.read(record, name)
                if _same(now, value):
                    return "already_applied", ""
                if expected is not None and not _same(now, expected):
                    return "drift_abstained", "" if now is None else str(now)
                try:
                    fetched(self._at(record), self.retry, body={"fields": {name: value}, "revision": revision}, method="PATCH")
                    break
                except urllib.error.HTTPError as e:
                    if e.code != 409:  # somebody else wrote in between: look again
                        raise
            else:
                return "error", "the record kept changing"
            now, _ = self.read(record, name)
            return ("written", "") if _same(now, value) else ("verify_failed", "" if now is None else str(now))
        except Exception as e:  # noqa: BLE001  one row's failure is its outcome
            return "error", f"{type(e).__name__}: {e}"


@dataclass
class Part(WriterCommitMessage):
    """What one task did: its outcome file, if it had rows, and the number of rows by status."""

    file: str = ""
    counts: dict[str, int] = field(default_factory=dict)


class CellWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.url, self.folder = options["url"], options["outcomes"]
        self.retry = Retry(int(options.get("retries", "3")), float(options.get("retryBase", "1.0")))

    def write(self, iterator: Iterator[Row]) -> Part:
        client, counts, fs, sink = CellClient(self.url, self.retry), Counter(), None, None
        name, rows = f"part-{uuid.uuid4().hex}.parquet", []
        schema = pa.schema([(c, pa.string()) for c in _COLUMNS])

        def flush() -> None:
            nonlocal fs, sink
            if sink is None:
                fs, at = opened(self.folder)
                fs.create_dir(at, recursive=True)
                sink = pq.ParquetWriter(f"{at}/{name}", schema, filesystem=fs)
            sink.write_table(pa.table([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], schema=schema))
            rows.clear()

        for r in iterator:
            if r["record_id"] is None or not r["field"]:
                status, detail = "error", "no record or field"
            else:
                status, detail = client.written(r["record_id"], r["field"], r["expected"], r["value"])
            counts[status] += 1
            rows.append((r["record_id"], r["field"], status, detail))
            if len(rows) == 4096:
                flush()
        if rows:
            flush()
        if sink is not None:
            sink.close()
        return Part(name if sink is not None else "", dict(counts))

    def commit(self, messages: list[Part | None]) -> None:
        """Name the outcome files that count, and the totals; a folder takes several writes."""
        parts = [m for m in messages if m is not None]
        total = sum((Counter(m.counts) for m in parts), Counter())
        fs, at = opened(self.folder)
        fs.create_dir(at, recursive=True)
        with fs.open_output_stream(f"{at}/commit-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"files": [m.file for m in parts if m.file], "counts": total}).encode())

    def abort(self, messages: list[Part | None]) -> None:
        """Cells that were written stay so, and running again finds them already applied; outcome files of an aborted write are not named."""
        fs, at = opened(self.folder)
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{at}/{m.file}")


class CellTable(DataSource):
    """rows.write.format("cell_table").option("url", ...).option("outcomes", folder).mode("append").save().

    rows: record_id, field, expected, value, all strings. Options: url, outcomes, retries, retryBase.
    """

    @classmethod
    def name(cls) -> str:
        return "cell_table"

    def schema(self) -> str:
        return "record_id string, field string, expected string, value string"

    def writer(self, schema: object, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("cells are appended to a remote table; it is never replaced")
        return CellWriter(self.options)


def write_cells(rows: DataFrame, url: str, outcomes: str, tasks: int = 8, **options: str) -> DataFrame:
    """Write rows (record_id, field, expected, value) and return (record_id, field, status, detail).

    Rows of one record go to one task, in order of field, so that no two tasks contend for its revision; at most `tasks` tasks ask the server at a time.
    """
    spark = rows.sparkSession
    spark.dataSource.register(CellTable)
    dealt = rows.select(*[rows[c].cast("string").alias(c) for c in ("record_id", "field", "expected", "value")]).repartition(tasks, "record_id").sortWithinPartitions("record_id", "field")
    dealt.write.format("cell_table").options(url=url, outcomes=outcomes, **options).mode("append").save()
    return read_outcomes(spark, outcomes)


def read_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, field, status, detail) of the rows of all committed writes to a folder."""
    fs, at = opened(folder)
    commits = [f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.base_name.startswith("commit-")]
    files = [name for c in commits for name in json.loads(fs.open_input_stream(c).read())["files"]]  # a name a task
    return spark.read.schema(OUTCOME).parquet(*[f"{folder}/{f}" for f in files]) if files else spark.createDataFrame([], OUTCOME)
