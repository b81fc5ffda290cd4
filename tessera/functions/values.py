"""Values read out of text cells: flags, times, versions, rates, result strings, converted units."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import as_col, collapsed, filled


@dataclass(frozen=True)
class Flag:
    """How one kind of cell spells a flag. unknown: the verdict on other words; None takes the blank's."""

    true: tuple[str, ...] = ("1", "true", "yes", "y")
    false: tuple[str, ...] = ("0", "false", "no", "n")
    blank: bool = False
    unknown: bool | None = False
    trimmed: bool = True


# The kinds of flag cells, each with its own reading of blanks and unknown words.
FLAGS = {
    "spec": Flag(blank=True),
    "copy": Flag(blank=False, unknown=None),
    "copy_default_true": Flag(blank=True, unknown=None),
    "lint": Flag(),
    "memory_latest": Flag(blank=True),
    "memory_enabled": Flag(blank=True, unknown=True),
    "index_latest": Flag(false=("0", "false", "no", "n", "off"), blank=True, unknown=True),
    "variable_default": Flag(),
    "block": Flag(blank=True, unknown=None),
    "localized": Flag(blank=True),
    "builder": Flag(true=("1", "true"), blank=True, trimmed=False),
}


def flag(c: Column | str, kind: str) -> Column:
    """Never null: the reading of a cell as FLAGS[kind] says."""
    f = FLAGS[kind]
    raw = F.coalesce(as_col(c).cast("string"), F.lit(""))
    word = F.lower(F.trim(raw))
    blank = (word == "") if f.trimmed else (raw == "")
    other = f.blank if f.unknown is None else f.unknown
    return F.when(blank, F.lit(f.blank)).when(word.isin(*f.true), F.lit(True)).when(word.isin(*f.false), F.lit(False)).otherwise(F.lit(other))


def boolish(c: Column | str, style: str) -> Column:
    """Flags in one spelling: upper_bool gives TRUE and FALSE, digit_bool 1 and 0; other words stay, blanks are empty."""
    yes, no = {"upper_bool": ("TRUE", "FALSE"), "digit_bool": ("1", "0")}[style]
    raw = F.trim(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.when(F.lower(raw).isin(*Flag().true), F.lit(yes)).when(F.lower(raw).isin(*Flag().false), F.lit(no)).otherwise(raw)


def time_of(c: Column | str) -> Column:
    """ISO text (Z or an offset; without one it is UTC) or epoch seconds or milliseconds; null for anything else.

    Numbers over 1e10 are milliseconds; zero and less give null. Reads in a session whose time zone is UTC.
    """
    text = F.trim(as_col(c).cast("string"))
    number = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
    seconds = F.when(number > 1e10, number / 1000).otherwise(number)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), text.try_cast("timestamp"))
    return F.when(number.isNotNull(), F.when(number > 0, F.timestamp_millis((seconds * 1000).cast("long")))).otherwise(iso)


def iso_seconds(c: Column | str) -> Column:
    return F.coalesce(F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))


def month(c: Column | str) -> Column:
    return F.substring(as_col(c).cast("string"), 1, 7)


def result_fields(c: Column | str) -> Column:
    """'STATUS | key=value | ...' as (status in lower case, map of lower-case keys); later keys win."""
    parts = F.filter(F.transform(F.split(F.coalesce(as_col(c), F.lit("")), r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    pairs = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.contains("="))
    entry = lambda p: F.struct(F.lower(F.trim(F.substring_index(p, "=", 1))).alias("key"), F.trim(F.substr(p, F.instr(p, "=") + 1)).alias("value"))
    last = lambda es: F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda later: later["key"] == e["key"]))
    entries = F.transform(F.array(F.transform(pairs, entry)), last)[0]  # the entries are made once
    return F.struct(F.coalesce(F.lower(F.get(parts, F.lit(0))), F.lit("")).alias("status"), F.map_from_entries(entries).alias("values"))


def result_value(c: Column | str, key: str, fold: bool = True) -> Column:
    """The last value of one key of a result string, empty without one: one regular expression, no map."""
    text = F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"^[\s|]+", "")
    return F.trim(F.regexp_extract(text, rf"(?s{'i' if fold else ''})^.*\|\s*{key}\s*=([^|]*)", 1))


def result_status(c: Column | str) -> Column:
    return F.lower(F.trim(F.substring_index(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"^[\s|]+", ""), "|", 1)))


def freshness(result: Column | str, started: Column | str, since: Column | str) -> Column:
    """(status, is_fresh, built_at) of a queue result against the time a fresh one was asked for."""
    read = F.struct(result_status(result).alias("said"), time_of(result_value(result, "built_at")).alias("built"), time_of(started).alias("begun"), time_of(since).alias("asked"))
    none = F.coalesce(as_col(result), F.lit("")) == ""

    def judged(x: Column) -> Column:
        fresh, waiting = x["built"] >= x["asked"], F.coalesce(x["begun"] >= x["asked"], F.lit(False))
        done = F.when(x["said"].startswith("success"), "fresh_success").when(x["said"].rlike("^(failed|failure)"), "fresh_failure").otherwise("fresh_result")
        status = F.when(x["asked"].isNull(), "not_requested").when(fresh, done).when(x["built"].isNotNull(), "stale_result").when(waiting, "writeback_pending").when(none, "pending").otherwise("stale_result")
        is_fresh = F.when(x["asked"].isNotNull(), F.coalesce(fresh, F.when(~waiting & ~none, F.lit(False))))
        return F.struct(status.alias("status"), is_fresh.alias("is_fresh"), x["built"].alias("built_at"))

    return F.get(F.transform(F.array(read), judged), F.lit(0))  # each time is read once


def claim(c: Column | str) -> Column:
    """(token, expires) of a running result that names both; else null."""
    text = F.trim(F.coalesce(as_col(c), F.lit("")))
    token, expires = filled(result_value(text, "claim_token", False)), time_of(result_value(text, "claim_expires_at", False))
    held = text.rlike(r"^RUNNING\s*(\||$)") & token.isNotNull() & expires.isNotNull()
    return F.when(held, F.struct(token.alias("token"), expires.alias("expires")))


def claim_active(c: Column | str, now: Column) -> Column:
    """Whether a lease ends strictly later than now."""
    return F.coalesce(claim(c)["expires"] > now, F.lit(False))


def version_key(c: Column | str) -> Column:
    """Sorts versions: numeric ones (an optional v, digits and dots) by their numbers, above any other text."""
    text = F.trim(F.coalesce(as_col(c), F.lit("")))
    plain = F.regexp_replace(text, "^[vV]", "")
    numeric = plain.rlike(r"^\d+(\.\d+)*$")
    numbers = F.when(numeric, F.transform(F.split(plain, r"\."), lambda p: p.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.struct(numeric.cast("int").alias("numeric"), numbers.alias("numbers"), F.when(numeric, plain).otherwise(F.lower(plain)).alias("text"))


def rate(part: Column | str, whole: Column | str) -> Column:
    """part / whole to four digits; null where whole is zero or null."""
    return F.round(F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double")), 4)


def percent_text(part: Column | str, whole: Column | str) -> Column:
    return F.format_string("%.1f%%", F.try_divide(as_col(part).cast("double") * 100, as_col(whole).cast("double")))


def _digits(c: Column) -> Column:
    """A decimal without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


# The texts that named transforms give, with the places of their parts.
_CAPACITY, _CYCLES, _DIRECT = "%s Wh (%s Ah / %s V DC)", "%s cycles to 70%%+ capacity", "%s V⎓%s A max."
_KILOS, _POUNDS = "About %s kg", "About %s lbs/%s kg"
_UNITS = ("Wh", "Ah", "Kg", "mm", "cycles", "V", "A")
_RANGE = r"(-?\d+)\s*[~\-–]\s*(-?\d+)\s*℃"


def amounts(text: Column) -> Column:
    """All (number, unit) of a text in order, units of _UNITS in lower case."""
    pattern = F.lit(rf"(?i)(\d[\d.]*)\s*({'|'.join(_UNITS)})")
    return F.zip_with(F.regexp_extract_all(text, pattern, 1), F.regexp_extract_all(text, pattern, 2), lambda n, u: F.struct(n.alias("n"), F.lower(u).alias("u")))


def converted(op: Column | str, raw: Column | str, default: Column | str, region: Column | str) -> Column:
    """(value, status) of a raw specification value under a named transform.

    US asks for imperial units beside metric ones. What cannot be made out for certain keeps the raw value and
    the status needs_review; so does every temperature, whose parts a person has to tell apart.
    """
    kind, text, spare, us = F.lower(as_col(op)), collapsed(raw), filled(default), F.upper(F.coalesce(as_col(region), F.lit(""))) == "US"

    def made_of(read: Column) -> Column:
        all_of = lambda unit: F.transform(F.filter(read, lambda x: x["u"] == unit), lambda x: x["n"])
        one = lambda unit: F.get(all_of(unit), F.lit(0))
        put = lambda shape, *parts: F.when(reduce(lambda p, q: p & q, [x.isNotNull() for x in parts]), F.format_string(shape, *parts))
        sides = F.transform(F.slice(all_of("mm"), 1, 3), lambda x: x.cast("double"))
        laid = lambda each, unit: F.concat(F.array_join(F.transform(sides, each), " × "), F.lit(unit))
        cm, inch = laid(lambda x: _digits(F.round(x / 10, 1)), " cm"), laid(lambda x: F.format_string("%.1f", x / 25.4), " in")
        kilos = one("kg")
        return (
            F.when(kind == "weight", F.when(us, put(_POUNDS, F.round(kilos.cast("double") * 2.20462, 2).cast("string"), kilos)).otherwise(put(_KILOS, kilos)))
            .when(kind == "dc12", put(_DIRECT, one("v"), one("a"))).when(kind == "cycle_life", put(_CYCLES, one("cycles")))
            .when((kind == "dims_mm_to_cm") & (F.size(sides) == 3), F.when(us, F.concat(inch, F.lit(" / "), cm)).otherwise(cm))
            .when(kind == "capacity", put(_CAPACITY, one("wh"), one("ah"), one("v")))
        )

    made = F.get(F.transform(F.array(amounts(text)), made_of), F.lit(0))  # the text is read once
    ends = [F.nullif(F.regexp_extract(text, _RANGE, i), F.lit("")) for i in (1, 2)]
    between = lambda parts, unit: F.concat(parts[0], F.lit(f" {unit} to "), parts[1], F.lit(f" {unit}"))
    celsius = between(ends, "°C")
    warmer = between([F.bround(x.cast("double") * 9 / 5 + 32).cast("int").cast("string") for x in ends], "°F")
    heat = F.when(kind == "temp", F.when(us, F.concat(warmer, F.lit(" / "), celsius)).otherwise(celsius))
    bare, plain = text == "", kind.isin("default", "passthrough")
    value = F.when(kind != "exclude", F.when((kind == "default") | bare, spare).otherwise(F.coalesce(made, heat, text)))
    known = F.when(bare & (kind != "default"), F.when(spare.isNotNull(), "direct")).when(plain, "direct").when(made.isNotNull(), "transformed")
    status = F.when(kind == "exclude", "excluded").otherwise(F.coalesce(known, F.lit("needs_review")))
    return F.struct(value.cast("string").alias("value"), status.alias("status"))
