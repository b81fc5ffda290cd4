"""What several operators of this package share: row keys, written intermediate tables, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts go to Python in Arrow batches of at most so many bytes, whatever their number of rows.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A public tokenizer's file: in folder, or where the installed vocabulary package has it."""
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where the session names none, one is made for a local master, as
    in tests; on a cluster that would be the driver's own disk, so it is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives a lost executor."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most_bytes: int = 8 << 20) -> bool:
    """Whether df, measured as text, is small enough to broadcast."""
    return (df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= most_bytes


def row_keys(*cols: Column | str) -> tuple[Column, Column]:
    """Two 64-bit hashes, never null, that name a row by its content; rows that agree in all cols are one."""
    named = [x for c in (F.col(c) if isinstance(c, str) else c for c in cols) for x in (c.isNull(), c)]  # a hash passes over nulls
    return F.xxhash64(*named), F.xxhash64(F.lit(7), *reversed(named), F.lit(11))


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow in batches of bounded bytes: lowers the session's limit where that is higher."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    most = conf.get(key).removesuffix("b")
    if not most.isdigit() or not 0 < int(most) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
