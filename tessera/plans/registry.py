"""Named queries over the supplied tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """t.orders is the orders table of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def rows(self, data: list[tuple], schema: str) -> DataFrame:
        """A small inline table."""
        return self.spark.createDataFrame(data, schema)

    def folder(self) -> str:
        """A new folder that the driver and all executors share; one of this machine only for a local master."""
        context = self.spark.sparkContext
        shared = context.getCheckpointDir() or self.spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return f"{shared or tempfile.mkdtemp(prefix='spark-')}/queries/{uuid.uuid4().hex}"


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of Tables under its own name."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
