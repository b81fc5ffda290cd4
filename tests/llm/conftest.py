from __future__ import annotations

import pytest
from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    line = " ".join(WORDS[:12])
    rows = [
        (1, line, "en", "a"), (1, line, "en", "a"), (1, "other text of the same id", "en", None), (2, line + "\n" + line.replace("beta", "BETA"), None, "a"),
        (3, None, "en", "b"), (None, line, "en", "b"), (None, None, None, None), (4, "", "en", "a"), (5, "   \n\t\n", "en", "b"),
        (6, (line + " ") * 400, "en", "a"), (7, "é" * 250 + " 日本語 " + "é" * 250, "ja", "c"), (8, "x", "en", "c"), (9, "\n" + line + "\r\n", "en", "c"),
    ]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
    df = spark.createDataFrame(rows, schema).selectExpr("*", "cast(length(text) as long) as n_chars")
    clash = ("h1", "k1", "k2", "line", "place", "size", "target", "rank", "before", "fp", "id", "root", "a", "n", "s", "b", "t1", "kept", "position", "hits", "bucket", "y", "score", "__k1", "__k2", "__h1", "__h2", "__gone", "gone", "row", "best", "keep", "lines_removed")
    return df.selectExpr("*", *[f"'{c}' as {c}" for c in clash])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def clashing():
    """A check that rows kept every column of odd_docs but those named, whatever its name, with its value."""

    def check(kept, docs, but=()):
        names = [c for c in docs.columns if c not in (*but, "doc_id", "text", "lang", "source", "n_chars")]
        assert [c for c in docs.columns if c not in but] == [c for c in kept.columns if c in docs.columns and c not in but]
        rows = kept.collect()
        assert rows and all(r[c] == c for r in rows for c in names)

    return check
