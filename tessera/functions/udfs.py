"""Arrow-batched functions for what no built-in expresses: Unicode forms, canonical JSON, fuzzy matching."""

from __future__ import annotations

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tessera.functions.text import as_col


def search_text(t: str | None) -> str:
    """NFKC, case-folded, punctuation as spaces, spaces collapsed."""
    folded = unicodedata.normalize("NFKC", t or "").casefold()
    return " ".join("".join(" " if unicodedata.category(ch)[0] in "PSZC" else ch for ch in folded).split())


@pandas_udf(T.StringType())
def search_form(text: pd.Series) -> pd.Series:
    """search_text of each text; null as empty."""
    return text.map(search_text)


@pandas_udf(T.StringType())
def search_form_parts(text: pd.Series) -> pd.Series:
    """search_text of each part of texts parted by U+0001, parted so again."""
    return text.map(lambda t: "\u0001".join(map(search_text, (t or "").split("\u0001"))))


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces, nulls kept and letters as they are."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


@pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """A JSON text in canonical form; null, broken JSON and JSON nested too deep for the parser give null."""

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else canonical(json.loads(t))
        except (ValueError, RecursionError):
            return None

    return text.map(one)


def content_hash(c: Column | str) -> Column:
    """SHA-256 of a JSON text's canonical form, as lower-case hex."""
    return F.sha2(canonical_json(as_col(c)), 256)


def stretch_distance(needle: str, hay: str) -> int:
    """The least number of edits (replace, insert, delete a character) that turn needle into some stretch of hay.

    One column of the edit-distance table is a pair of bit vectors of needle's length, moved on character by character,
    so that the cost is one pass over hay.
    """
    size = len(needle)
    high, full = 1 << (size - 1), (1 << size) - 1
    where: dict[str, int] = {}
    for i, ch in enumerate(needle):
        where[ch] = where.get(ch, 0) | (1 << i)
    more, less, now, best = full, 0, size, size
    for ch in hay:
        same = where.get(ch, 0)
        down = same | less
        across = (((same & more) + more) ^ more) | same
        up, drop = less | ~(across | more), more & across
        now += 1 if up & high else -1 if drop & high else 0
        best = min(best, now)
        up, drop = up << 1, drop << 1  # a stretch may begin anywhere: no cost comes in at the top
        more, less = (drop | ~(down | up)) & full, up & down & full
    return best


def partial_ratio_of(needle: str | None, hay: str | None) -> float:
    """How close (0 to 1) the shorter text is to the stretch of the longer one that is nearest to it: 1 less the edits a
    character of the shorter. One replaced, lacking or added character of n costs 1 / n."""
    if not needle or not hay:
        return 0.0
    short, long = (needle, hay) if len(needle) <= len(hay) else (hay, needle)
    return 1.0 if short in long else 1.0 - stretch_distance(short, long) / len(short)


@pandas_udf(T.DoubleType())
def partial_ratio(needle: pd.Series, hay: pd.Series) -> pd.Series:
    return pd.Series([partial_ratio_of(a, b) for a, b in zip(needle, hay, strict=True)], dtype="float64")
