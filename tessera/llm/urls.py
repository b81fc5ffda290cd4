"""URL filters from a sorted digest array.

Rules (host, path, verdict) are laid out as one file: sorted 64-bit xxhash keys of the rules' texts, their
offsets, and the texts themselves. Spark hands the file to every executor once; tasks memory-map it. A url is
looked up under each suffix of its host and each prefix of its path that any rule could have, all keys of a
batch by one vectorised binary search, and a hit counts only if the stored text equals what was looked up.
Among the rules found the longest decides; a url under no rule gets the default verdict.

A rule list over `most_bytes` is not shipped: the same keys then join the rules as tables, texts compared.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import arrow_map

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


class DigestArray:
    """A memory-mapped file: count, path lengths, sorted keys, offsets, then rule texts with a verdict byte."""

    def __init__(self, path: str):
        self.data = np.memmap(path, np.uint8, "r")
        n, lengths = struct.unpack("<QQ", self.data[:16].tobytes())
        self.lengths = np.frombuffer(self.data, "<u8", lengths, 16).tolist()
        self.keys = np.frombuffer(self.data, "<u8", n, 16 + 8 * lengths)
        self.offsets = np.frombuffer(self.data, "<u8", n + 1, 16 + 8 * lengths + 8 * n)
        self.base = 16 + 8 * lengths + 8 * n + 8 * (n + 1)

    @staticmethod
    def layout(rules: list[tuple[str, str, str]]) -> bytes:
        best: dict[bytes, str] = {}
        for host, path, verdict in rules:
            best[f"{host}{path}".encode()] = max(verdict, best.get(f"{host}{path}".encode(), ""))  # block before allow
        rows = sorted((xxhash.xxh64_intdigest(t), t, v) for t, v in best.items())
        lengths = sorted({len(p.encode()) for _, p, _ in rules})
        body = [(b"+" if v == "allow" else b"-") + t for _, t, v in rows]
        offsets = np.cumsum([0, *map(len, body)]).astype("<u8")
        keys = np.array([k for k, _, _ in rows], "<u8")
        return struct.pack("<QQ", len(rows), len(lengths)) + np.array(lengths, "<u8").tobytes() + keys.tobytes() + offsets.tobytes() + b"".join(body)

    def find(self, texts: list[bytes]) -> list[str | None]:
        """The verdict stored for each text, or None: binary search by key, then the text itself."""
        asked = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, asked)
        out: list[str | None] = [None] * len(texts)
        for i in np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == asked) if len(self.keys) else np.zeros(0, bool)).tolist():
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == asked[i]:  # equal keys of other texts stand side by side
                lo, hi = int(self.offsets[j]), int(self.offsets[j + 1])
                if self.data[self.base + lo + 1 : self.base + hi].tobytes() == texts[i]:
                    out[i] = "allow" if self.data[self.base + lo] == ord("+") else "block"
                    break
                j += 1
        return out


def parts(url: str | None) -> tuple[str, str]:
    """(host, path): host with A-Z lower-cased, path without query and fragment; both empty without '://'."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return host, path[:stop]


def lookups(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """Every rule text that would fit, the longest host first and then the longest path."""
    labels = host.split(".")
    data = path.encode()
    tails = [data[:n] for n in reversed(lengths) if n <= len(data)]
    return [".".join(labels[i:]).encode() + t for i in range(len(labels)) for t in tails] if host else []


def verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] | tuple = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url", most_bytes: int = 256 << 20) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page.

    rules: (host, path prefix, verdict), collected and bounded by the caller; the longest fitting rule text wins,
    block before allow among equal texts. Null urls and those without '://' have empty host and path and no rule.
    """
    spark = pages.sparkSession
    laid = DigestArray.layout(list(rules))
    if len(laid) > most_bytes:
        raise ValueError("the rules are too large to ship; give them as a table to joined_verdicts")
    name = f"rules-{hashlib.sha256(laid).hexdigest()[:16]}.bin"
    _ship(spark, name, laid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for b in batches:
            split = [parts(u) for u in b.column(1).to_pylist()]
            asked = [lookups(h, p, array.lengths) for h, p in split]
            found = iter(array.find([t for a in asked for t in a]))
            hits = [max(((len(t), t, v) for t, v in ((t, next(found)) for t in a) if v), default=None) for a in asked]
            cols = [[s[0] for s in split], [s[1] for s in split], [h and h[1].decode() for h in hits], [h[2] if h else default for h in hits]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in cols)], ["page_id", "host", "path", "rule", "verdict"])

    return arrow_map(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")), run, "page_id long, host string, path string, rule string, verdict string")


def _ship(spark: SparkSession, name: str, data: bytes) -> None:
    """Give every executor the file; Spark serves it from the driver and fetches it again where one is new."""
    if any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
    with open(path, "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(path)


def joined_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """As verdicts, for rules of any number in a table (host, path, verdict): an equi-join on the looked-up texts.

    Each url is looked up under at most its host labels times the distinct lengths of rule paths. Null urls and those
    without '://' have empty host and path and no rule; rules with a null host or path fit nothing; pages that repeat
    get a row each; an empty table gives no rows.
    """
    rules = rules.where("host is not null and path is not null")
    lengths = sorted(r[0] for r in rules.select(F.octet_length("path")).distinct().collect())  # lengths, at most as many as the longest path has bytes
    texts = rules.groupBy(F.concat("host", "path").alias("t")).agg(F.max("verdict").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [parts(u) for u in b.column(1).to_pylist()]
            asked = [[t.decode(errors="ignore") for t in lookups(h, p, lengths)] for h, p in split]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([s[0] for s in split]), pa.array([s[1] for s in split]), pa.array(asked, pa.list_(pa.string()))], ["page_id", "url", "host", "path", "asked"])

    split = arrow_map(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")), run, "page_id long, url string, host string, path string, asked array<string>")
    keys = split.select("host", "path", "asked").distinct().select("host", "path", F.explode("asked").alias("t"))
    best = keys.join(texts, "t").groupBy("host", "path").agg(F.max(F.struct(F.octet_length("t").alias("n"), "t", "v")).alias("m"))
    return split.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("m.t").alias("rule"), F.coalesce("m.v", F.lit(default)).alias("verdict"))


