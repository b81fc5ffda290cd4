"""Raw fields, JSON text, as the text of cells, by VARIANT expressions: all of it stays in the JVM.

A field that Spark's VARIANT does not take as JSON (broken, a key twice, nested over a thousand levels) stays the text it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import as_col

#: Lists in lists are read so deep; a list below that is shown as JSON.
_DEPTH = 4


def _number(shown: Column) -> Column:
    """A number's text: whole ones without a fraction, others with at most six digits, in scientific form from 1e6 on and below 1e-4; ties round up."""
    value = shown.cast("double")
    parts = F.split(F.format_string("%.5e", value), "e")
    digits, power = F.regexp_replace(parts[0], r"\.?0+$", ""), parts[1].cast("int")
    plain = F.regexp_replace(F.format_string("%.5e", value).cast("decimal(20,10)").cast("string"), r"\.?0+$", "")
    rounded = F.when(power.between(-4, 5), plain).otherwise(F.concat(digits, F.lit("e"), parts[1]))
    return F.when(shown.rlike(r"^-?\d+$"), shown).when((F.abs(value) >= 1 << 53) | (value == F.floor(value)), F.format_string("%.0f", value)).otherwise(rounded)


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _shown(v: Column, depth: int = _DEPTH) -> Column:
    """A VARIANT as a cell shows it; never null."""
    shown = F.to_json(v)
    begins = F.left(shown, F.lit(1))
    listed = F.array_join(F.transform(_items(v), lambda x: _shown(x, depth - 1)), ", ") if depth else shown
    by_mark = {"n": F.lit(""), "t": F.lit("TRUE"), "f": F.lit("FALSE"), '"': F.try_variant_get(v, "$", "string"), "[": listed, "{": shown}
    out = F.when(shown.isNull(), F.lit(""))
    for mark, text in by_mark.items():
        out = out.when(begins == mark, text)
    return out.otherwise(_number(shown))


def _chosen(v: Column, depth: int = _DEPTH) -> Column:
    """A VARIANT as a choice: an object stands for its first filled name, a list for its filled choices."""
    begins = F.left(F.to_json(v), F.lit(1))
    named = [F.trim(_shown(F.try_variant_get(v, f"$.{k}", "variant"))) for k in ("text", "name", "value")]
    first = F.coalesce(*[F.nullif(n, F.lit("")) for n in named], F.lit(""))
    listed = F.array_join(F.filter(F.transform(_items(v), lambda x: _chosen(x, depth - 1)), lambda t: t != ""), ", ") if depth else F.to_json(v)
    return F.when(begins == "{", first).when(begins == "[", listed).otherwise(_shown(v))


def cell_text(field: Column | str) -> Column:
    """A raw field as a cell's text: null is blank, booleans are TRUE and FALSE, lists are joined, objects are JSON with sorted keys."""
    raw = as_col(field)
    v = F.try_parse_json(raw)
    return F.when(raw.isNull(), "").when(v.isNull(), raw).otherwise(_shown(v))


def choice_text(field: Column | str) -> Column:
    """A raw field as a choice cell's text: the first filled one of an object's text, name and value; lists are joined."""
    raw = as_col(field)
    v = F.try_parse_json(raw)
    return F.when(raw.isNull(), "").when(v.isNull(), raw).otherwise(_chosen(v))
