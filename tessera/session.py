"""A session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, app: str = "tessera", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; conf names use __ for dots (spark__sql__ansi__enabled)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()
