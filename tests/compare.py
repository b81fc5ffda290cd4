"""Runs a query and its DuckDB SQL over the same tables and compares the rows, columns by name."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession


def oracle(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
        found = db.sql(sql)
        return found.columns, found.fetchall()


def plain(v: object) -> object:
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (bool, int)):
        return round(float(v), 9)
    return v


def differences(spark: SparkSession, sf_dir: str, query, sql: str) -> list[str]:  # noqa: ANN001
    df = query(spark, sf_dir)
    names, rows = oracle(sf_dir, sql)
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    order = sorted(names)
    ours = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in rows)
    return [f"ours only: {list((ours - theirs).items())[:3]}", f"theirs only: {list((theirs - ours).items())[:3]}", f"{sum(ours.values())} and {sum(theirs.values())} rows"] if ours != theirs else []
