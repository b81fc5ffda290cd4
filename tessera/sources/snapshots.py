"""Snapshots: tables written together with a manifest, compared with the last, and published by one rename."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import filled, sort_token
from tessera.sources.schema import TABLES, TableSpec


def table_digest(df: DataFrame) -> DataFrame:
    """One row (row_count, digest): a name for the rows of a table whatever their order.

    Two sums of row hashes, so that it is an aggregate with partial results and not a pass over sorted text."""
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in df.columns]
    part = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")
    return df.agg(F.count("*").alias("row_count"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), part(1), part(2)), 256).alias("digest"))


def in_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the table's canonical order: numbers by value before texts, then all columns."""
    return df.orderBy(*[sort_token(F.col(f"`{c}`")) for c in spec.sort], *[F.col(f"`{c}`") for c in spec.columns if c not in spec.sort])


def manifest(spark: SparkSession, tables: dict[str, DataFrame], last: DataFrame | None = None) -> DataFrame:
    """(table, row_count, digest, changed): one row per table; changed against the last manifest, true without one."""
    rows = None
    for name, df in tables.items():
        row = table_digest(df).select(F.lit(name).alias("table"), "row_count", "digest")
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        return spark.createDataFrame([], "table string, row_count long, digest string, changed boolean")
    if last is None:
        return rows.withColumn("changed", F.lit(True))
    return rows.join(last.select("table", F.col("digest").alias("__d")), "table", "left").withColumn("changed", ~F.col("digest").eqNullSafe(F.col("__d"))).drop("__d")


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, formats: str = "parquet", tries: int = 20) -> str:
    """Write all tables and the manifest to a new folder under root, then name it current; returns its path.

    All is written before anything is visible. Each snapshot has a small file of its own, CURRENT-<number>, and the greatest finished one
    counts. There is no lock to break: whoever creates the next number first has it, and a writer that finds it taken
    compares its tables with the snapshot that came in between and tries the number after. A writer that stalls or dies, at whatever point,
    holds nobody up, and one that comes back late takes a number of its own or finishes one that newer snapshots have passed.
    """
    path = f"{root}/{uuid.uuid4().hex}"
    for name, df in tables.items():
        out = in_order(df, TABLES[name]) if name in TABLES and set(TABLES[name].columns) == set(df.columns) else df
        (out.write.option("header", True).csv(f"{path}/{name}") if formats == "csv" else out.write.parquet(f"{path}/{name}"))
    manifest(spark, tables).write.parquet(f"{path}/_digests")
    digests = spark.read.parquet(f"{path}/_digests").drop("changed")
    for _ in range(tries):
        taken = [n for n, _ in _pointers(spark, root)]
        base = current(spark, root)
        was = spark.read.parquet(f"{base}/_manifest").select("table", F.col("digest").alias("was")) if base else digests.select("table", F.lit(None).cast("string").alias("was"))
        digests.join(was, "table", "left").withColumn("changed", ~F.col("digest").eqNullSafe(F.col("was"))).drop("was").write.mode("overwrite").parquet(f"{path}/_manifest")
        if _claimed(spark, f"{root}/CURRENT-{max(taken, default=0) + 1:012d}", path):
            return path
    raise RuntimeError(f"{root}: other writers were first {tries} times")


def _claimed(spark: SparkSession, pointer: str, content: str) -> bool:
    """Create a pointer file unless it is there, by the file system's exclusive create, and fill it; whether it was created here."""
    fs, at = _fs(spark, pointer)
    fs.mkdirs(at.getParent())
    if fs.getUri().getScheme() == "file":  # its create() looks first and creates then, which two writers can do at once
        if not spark.sparkContext._jvm.java.io.File(at.toUri().getPath()).createNewFile():
            return False
        stream = fs.create(at, True)
    else:
        try:
            stream = fs.create(at, False)
        except Py4JJavaError:
            if fs.exists(at):
                return False
            raise
    stream.write(bytearray(f"{content}\n".encode()))
    stream.close()
    return True


def _pointers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, file) of the pointers that were created, finished or not."""
    fs, p = _fs(spark, root)
    found = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [(int(f.getName().removeprefix("CURRENT-")), f.toString()) for f in found if f.getName().startswith("CURRENT-")]


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the published snapshot, or None. A pointer without a line, as a writer leaves it that stopped in between, does not count."""
    for _, file in sorted(_pointers(spark, root), reverse=True):
        if (line := spark.read.text(file).first()) is not None and line[0]:
            return line[0]
    return None


def inspect(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """(table, state) of a snapshot: ok, missing, or count for one whose rows are not as many as the manifest says."""
    listed = {r["table"]: r["row_count"] for r in spark.read.parquet(f"{path}/_manifest").collect()}  # a row per table
    rows = []
    for t in required:
        if t not in listed or not exists(spark, f"{path}/{t}"):
            rows.append((t, "missing"))
        else:
            rows.append((t, "ok" if spark.read.parquet(f"{path}/{t}").count() == listed[t] else "count"))
    return spark.createDataFrame(rows, "table string, state string")


def append_new(rows: DataFrame, path: str, key: str) -> None:
    """Append to a Parquet ledger the rows whose key it lacks, the first of each key; running it again adds nothing."""
    spark = rows.sparkSession
    fresh = rows.where(filled(key).isNotNull()).dropDuplicates([key])
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti").select(*rows.columns)
    fresh.write.mode("append").parquet(path)


def backup(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def restore(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, as a multiset, that only one of two tables has, with `side` a or b; none if a restore is true."""
    cols = a.columns
    return a.exceptAll(b.select(*cols)).withColumn("side", F.lit("a")).unionByName(b.select(*cols).exceptAll(a).withColumn("side", F.lit("b")))
