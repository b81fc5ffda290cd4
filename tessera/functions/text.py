"""Text helpers as Column expressions: they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# How cells that hold several values are parted, by kind of column.
SEPARATORS = {
    "dimension": r"[,;\r\n]+",
    "copy_tags": r"[,;|/\n、，]+",
    "copy_model": r"[,;|/\s、，]+",
    "page": r"[,;/]+",
    "variable_model": r"[,;|]",
    "queue_key": r"[,，/、\s]+",
    "product_model": r"[,，/、]+",
    "sku": r"[|]",
}
_IMAGE = r"!\[[^\]]*\]\([^)]*\)|<img\b[^>]*>|\|[A-Za-z0-9_]+_img\|"
_WIDE = r"[\x{1100}-\x{115F}\x{2E80}-\x{303E}\x{3041}-\x{33FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A000}-\x{A4CF}\x{AC00}-\x{D7A3}\x{F900}-\x{FAFF}\x{FE30}-\x{FE6F}\x{FF00}-\x{FF60}\x{FFE0}-\x{FFE6}]"
#: Java character classes of the scripts that a text's language is told by.
SCRIPTS = {"latin": r"\p{IsLatin}", "han": r"\p{IsHan}", "kana": r"[\p{IsHiragana}\p{IsKatakana}]", "hangul": r"\p{IsHangul}", "cyrillic": r"\p{IsCyrillic}"}


#: Languages that a source text may be in.
SOURCE_LANGUAGES = ("en", "zh", "ja", "fr", "es", "pt-br", "de", "it", "uk", "ko")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapsed(c: Column | str) -> Column:
    """Runs of Unicode white space as one space, trimmed; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"(?U)\s+", " "))


def filled(c: Column | str) -> Column:
    """The trimmed text, or null where it is blank."""
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """The first that is not blank, trimmed; empty where none is."""
    return F.coalesce(*map(filled, cols), F.lit(""))


def alias_filled(c: Column | str, *aliases: Column | str) -> Column:
    """c as it stands, or where it is blank the first alias that is not."""
    return F.when(filled(c).isNotNull(), as_col(c)).otherwise(F.coalesce(*map(filled, aliases), as_col(c)))


def inline_norm(c: Column | str) -> Column:
    """For comparing prose: image marks to a token, tags, zero-width and bold marks away, quotes folded."""
    text = F.regexp_replace(F.coalesce(as_col(c), F.lit("")), _IMAGE, "[image]")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    text = F.regexp_replace(text, r"[\x{200B}-\x{200D}\x{2060}\x{FEFF}]", "")
    text = F.translate(F.regexp_replace(text, r"\*\*|__", ""), "“”„‘’‚«»", "\"\"\"'''\"\"")
    return collapsed(text)


def model_token(c: Column | str, region: Column | str) -> Column:
    """A model name without a trailing _REGION or -REGION; as it stands where the region is blank."""
    text, place = F.trim(as_col(c)), F.coalesce(F.trim(as_col(region)), F.lit(""))
    tail = F.lower(F.right(text, F.length(place) + 1))
    marked = (place != "") & ((tail == F.concat(F.lit("_"), F.lower(place))) | (tail == F.concat(F.lit("-"), F.lower(place))))
    return F.when(marked, F.rtrim(F.regexp_replace(F.trim(F.left(text, F.length(text) - F.length(place) - 1)), r"[_-]+$", ""))).otherwise(text)


def tokens(c: Column | str, separators: str = SEPARATORS["dimension"]) -> Column:
    """The distinct non-blank parts of a cell, trimmed, in order; empty array for null."""
    parts = F.transform(F.split(F.coalesce(as_col(c), F.lit("")), separators), lambda t: F.trim(t))
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def literal_list(c: Column | str, separators: str = SEPARATORS["variable_model"]) -> Column:
    """Tokens of a cell that may also be written as a list literal: ['A', 'B'] or ["A", "B"]."""
    text = F.trim(as_col(c))
    inner = F.from_json(F.translate(text, "'", '"'), "array<string>")
    return F.when(text.rlike(r"^\[.*\]$") & inner.isNotNull(), F.array_distinct(F.filter(F.transform(inner, lambda t: F.trim(t)), lambda t: t != ""))).otherwise(tokens(text, separators))


def short_name(c: Column | str, vendor: str) -> Column:
    return F.trim(F.regexp_replace(as_col(c), rf"(?i)^\s*\Q{vendor}\E\s+", ""))


def lowered_label(c: Column | str) -> Column:
    """Words in lower case, but for words in capitals, of which BUTTON alone is lowered."""
    words = F.split(collapsed(c), " ")
    keep = lambda w: w.rlike(r"^[^a-z]*[A-Z][^a-z]*$") & (F.length(F.regexp_replace(w, "[^A-Z]", "")) > 1) & (w != "BUTTON")
    return F.array_join(F.transform(words, lambda w: F.when(keep(w), w).otherwise(F.lower(w))), " ")


def param_value(param: Column | str, value: Column | str, lang: Column | str) -> Column:
    """'param: value', with the full-width colon for Chinese and Japanese; the one that is filled if only one is."""
    p, v = filled(param), filled(value)
    sep = F.when(F.lower(as_col(lang)).isin("zh", "ja", "jp"), F.lit("：")).otherwise(F.lit(": "))
    return F.when(p.isNull(), F.coalesce(v, F.lit(""))).when(v.isNull(), p).otherwise(F.concat(p, sep, v))


def derived_forms(name: Column | str, value: Column | str) -> Column:
    """Map of a placeholder's own value and its _BOLD and _LOWER forms."""
    n, v = as_col(name), as_col(value)
    return F.create_map(n, v, F.concat(n, F.lit("_BOLD")), F.concat(F.lit("**"), v, F.lit("**")), F.concat(n, F.lit("_LOWER")), lowered_label(v))


def is_east_asian(c: Column | str) -> Column:
    return as_col(c).rlike(_WIDE)


def script_count(c: Column | str, script: str) -> Column:
    return F.coalesce(F.regexp_count(as_col(c), F.lit(SCRIPTS[script])), F.lit(0))


def script_ratio(c: Column | str, script: str) -> Column:
    """Share of a script among the letters of all scripts; null without letters."""
    letters = F.coalesce(F.regexp_count(as_col(c), F.lit(r"\p{L}")), F.lit(0))
    return F.when(letters > 0, script_count(c, script) / letters)


def display_width(c: Column | str) -> Column:
    """Columns on a terminal: wide characters of East Asian scripts count twice."""
    return F.length(as_col(c)) + F.coalesce(F.regexp_count(as_col(c), F.lit(_WIDE)), F.lit(0))


def search_tokens(c: Column | str) -> Column:
    """Query tokens, repeats included: ASCII words, runs of kana, runs of Han characters."""
    return F.regexp_extract_all(F.coalesce(F.lower(collapsed(c)), F.lit("")), F.lit(r"[A-Za-z0-9_./-]+|[\p{IsHiragana}\p{IsKatakana}ー]+|[\x{4E00}-\x{9FFF}]+"), 0)


def sentences(c: Column | str) -> Column:
    parts = F.transform(F.split(F.coalesce(as_col(c), F.lit("")), r"(?<=[.!?。！？])\s*|\n+"), lambda s: F.trim(s))
    return F.array_distinct(F.filter(parts, lambda s: s != ""))


def cells(c: Column | str) -> Column:
    """The texts of a table row's cells: parted at pipes, <br> and </td>, tags removed, blanks left out."""
    parts = F.split(F.coalesce(as_col(c), F.lit("")), r"(?i)\||<br\s*/?>|</t[dh]>")
    return F.filter(F.transform(parts, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"<[^>]*>", " "), r"\s+", " "))), lambda p: p != "")


def sort_token(c: Column | str) -> Column:
    """Numbers by value before texts by lower case; blank counts as the empty text."""
    text = F.trim(F.coalesce(as_col(c), F.lit("")))
    number = text.try_cast("double")
    return F.struct(number.isNull().alias("is_text"), number.alias("number"), F.when(number.isNull(), F.lower(text)).alias("text"))


def slug(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(as_col(c), F.lit(""))), r"[^a-z0-9]+", "_"), F.lit("_"))


def zero_padded(c: Column | str, width: int) -> Column:
    """Integral numbers padded with zeros; anything else as its slug."""
    number = F.regexp_extract(F.trim(as_col(c)), r"^(\d+)(?:\.0+)?$", 1)
    return F.when(number != "", F.lpad(number, width, "0")).otherwise(slug(c))


def composite_key(*parts: Column | str) -> Column:
    return F.array_join(F.filter(F.array(*map(slug, parts)), lambda p: p != ""), "__")


def split_key(c: Column | str) -> Column:
    """MODEL_REGION to (model, region) at the last underscore; all model where there is none."""
    text = F.trim(as_col(c))
    return F.struct(F.when(text.contains("_"), F.regexp_extract(text, r"^(.*)_[^_]*$", 1)).otherwise(text).alias("model"), F.when(text.contains("_"), F.substring_index(text, "_", -1)).otherwise(F.lit("")).alias("region"))


def unlinked(c: Column | str) -> Column:
    """[text](address) as (text, address); any other text stands for both."""
    text, pattern = F.trim(as_col(c)), r"^\[([^\]]*)\]\(([^)]*)\)$"
    linked = text.rlike(pattern)
    return F.struct(F.when(linked, F.regexp_extract(text, pattern, 1)).otherwise(text).alias("text"), F.when(linked, F.regexp_extract(text, pattern, 2)).otherwise(text).alias("address"))


def circled(n: Column | str) -> Column:
    """The circled numeral of 1 to 20, beyond that the number in parentheses."""
    return F.when(as_col(n).between(1, 20), F.substring(F.lit("①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"), as_col(n).cast("int"), F.lit(1))).otherwise(F.concat(F.lit("("), as_col(n).cast("string"), F.lit(")")))


def substituted(c: Column | str, values: Column, left: str = "{{", right: str = "}}") -> Column:
    """c with every {{key}} of the map `values` replaced, keys in order; unknown ones stay."""
    entries = F.array_sort(F.map_entries(values))
    return F.aggregate(entries, as_col(c), lambda acc, e: F.replace(acc, F.concat(F.lit(left), e["key"], F.lit(right)), F.coalesce(e["value"], F.lit(""))))


def log_line(c: Column | str) -> Column:
    """A log line without what differs between machines: absolute paths cut to the file, line numbers masked."""
    text = F.regexp_replace(as_col(c), r"(?:[A-Za-z]:)?(?:[/\\][^\s:/\\]+)+[/\\]([^\s:/\\]+)", "$1")
    return collapsed(F.regexp_replace(text, r":\d+(?::\d+)?", ":N"))


def urls(c: Column | str) -> Column:
    found = F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(r"https?://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+"), 0)
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?)'\"]+$", ""))


def emails(c: Column | str) -> Column:
    found = F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), 0)
    return F.transform(found, lambda m: F.lower(m))


def list_items(c: Column | str) -> Column:
    """Items of bullet or numbered lists and of HTML lists, tags removed."""
    text = F.coalesce(as_col(c), F.lit(""))
    marked = F.regexp_extract_all(text, F.lit(r"(?m)^\s*(?:[-*•]|#\.|\d+[.)])\s+(.+)$"), 1)
    tagged = F.regexp_extract_all(text, F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1)
    return F.filter(F.transform(F.concat(marked, tagged), lambda t: collapsed(F.regexp_replace(t, r"<[^>]*>", " "))), lambda t: t != "")


# Digits whose Korean reading ends in a consonant, and marks that do not count as a word's end.
CLOSED_DIGITS = "013678"
_END_MARKS = " \t\u00a0.,:;!?()[]{}'\"“”‘’*"


def ends_closed(c: Column | str, readings: dict[str, bool] | None = None) -> Column:
    """Whether a text is read with a consonant at its end in Korean: by its last syllable or digit, or for the last word in
    Latin letters by `readings` (lower case); null where that is not known."""
    bare = F.rtrim(as_col(c), F.lit(_END_MARKS))
    last = F.right(bare, F.lit(1))
    code = F.ascii(last)
    word = F.lower(F.ltrim(F.element_at(F.split(bare, r"\s+"), -1), F.lit(_END_MARKS)))
    known = [F.when(word == w, F.lit(closed)) for w, closed in (readings or {}).items()]
    return F.when(code.between(0xAC00, 0xD7A3), (code - 0xAC00) % 28 != 0).when(last.rlike("^[0-9]$"), F.contains(F.lit(CLOSED_DIGITS), last)).otherwise(F.coalesce(*known, F.lit(None).cast("boolean")))


def with_particle(c: Column | str, after_consonant: str, after_vowel: str, readings: dict[str, bool] | None = None) -> Column:
    """A Korean noun with the particle that its reading asks for; null where the reading is not known."""
    closed = ends_closed(c, readings)
    return F.when(closed.isNotNull(), F.concat(as_col(c), F.when(closed, F.lit(after_consonant)).otherwise(F.lit(after_vowel))))


_ESCAPES = {
    "html": [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")],
    "rst": [("\\", "\\\\"), ("*", "\\*"), ("`", "\\`"), ("|", "\\|"), ("_", "\\_")],
    "latex": [("\\", "\u0000"), ("{", "\\{"), ("}", "\\}"), ("\u0000", "\\textbackslash{}"), *[(c, f"\\{c}") for c in "&%$#_"], ("~", "\\textasciitilde{}"), ("^", "\\textasciicircum{}")],
}


def escaped(c: Column | str, markup: str) -> Column:
    """Text made safe for html, rst or latex."""
    return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), _ESCAPES[markup], as_col(c))


def masked(c: Column | str, allowed: list[str]) -> Column:
    """c without the allowed literals, the longest first, so that a part of one is never left over."""
    return reduce(lambda text, word: F.replace(text, F.lit(word), F.lit(" ")), sorted(allowed, key=lambda w: (-len(w), w)), as_col(c))


def outside(c: Column | str, pattern: Column | str, allow: Column | str) -> Column:
    """All hits of a pattern in what is left of c after the allowed pattern's hits are removed."""
    left = F.when(F.coalesce(as_col(allow), F.lit("")) == "", as_col(c)).otherwise(F.regexp_replace(as_col(c), as_col(allow), F.lit("")))
    return F.regexp_extract_all(F.coalesce(left, F.lit("")), as_col(pattern), F.lit(0))


def unit_value(value: Column | str, unit: Column | str) -> Column:
    """A value with its unit, a space between unless the unit is a degree, percent or empty."""
    v, u = F.trim(as_col(value)), F.coalesce(F.trim(as_col(unit)), F.lit(""))
    return F.when(v == "", F.lit("")).when(u == "", v).when(u.rlike("^[°%]"), F.concat(v, u)).otherwise(F.concat(v, F.lit(" "), u))


def split_target(c: Column | str, regions: Sequence[str]) -> Column:
    """MODEL_REGION_REST cut at its last part that is a known region: (model, region, rest); all model without one."""
    parts = F.split(F.trim(as_col(c)), "_")
    last = F.size(parts) - F.array_position(F.reverse(F.transform(parts, lambda p: F.upper(p).isin(*[r.upper() for r in regions]))), True)  # from 0
    found = F.exists(parts, lambda p: F.upper(p).isin(*[r.upper() for r in regions]))
    at = last.cast("int")
    join = lambda a: F.array_join(a, "_")
    return F.when(found, F.struct(join(F.slice(parts, F.lit(1), at)).alias("model"), F.get(parts, at).alias("region"), join(F.slice(parts, at + 2, F.size(parts))).alias("rest"))).otherwise(F.struct(F.trim(as_col(c)).alias("model"), F.lit("").alias("region"), F.lit("").alias("rest")))
