"""Whether a row applies to a target: one builder for every reading of model, region, market and page cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import SEPARATORS, as_col, filled, model_token, tokens


@dataclass(frozen=True)
class Dimension:
    """blank: whether a blank cell applies; everyone: words that apply to all; untargeted: the verdict where the
    query names no target ('cell' asks the cell: blank or everyone); exact: letter case counts."""

    separators: str = SEPARATORS["dimension"]
    blank: bool = True
    everyone: tuple[str, ...] = ("all",)
    untargeted: bool | str = True
    exact: bool = False


# The readings that differ between kinds of rows.
DIMENSIONS = {
    "spec": Dimension(everyone=()),
    "memory": Dimension(),
    "symbol_market": Dimension(SEPARATORS["copy_model"], blank=False, everyone=("all", "global"), untargeted=False),
    "block_model": Dimension(SEPARATORS["copy_model"], untargeted="cell"),
    "trouble_region": Dimension(SEPARATORS["copy_model"]),
    "asset": Dimension(blank=False, untargeted="cell"),
    "sku": Dimension(SEPARATORS["sku"], exact=True),
}


def applies(cell: Column | str, target: Column | str, kind: str = "spec", canonical_region: Column | str | None = None) -> Column:
    """Never null. canonical_region: model names lose that region's suffix on both sides first."""
    d = DIMENSIONS[kind]
    fold = (lambda c: c) if d.exact else F.lower
    cut = (lambda c: model_token(c, canonical_region)) if canonical_region is not None else (lambda c: c)
    parts, goal = tokens(cell, d.separators), filled(target)
    for_all = F.exists(parts, lambda t: F.lower(t).isin(*d.everyone)) if d.everyone else F.lit(False)
    own = for_all | ((F.size(parts) == 0) & F.lit(d.blank))
    named = F.exists(parts, lambda t: fold(cut(t)) == fold(cut(goal)))
    bare = own if d.untargeted == "cell" else F.lit(d.untargeted)
    return F.coalesce(F.when(goal.isNull(), bare).otherwise(own | named), F.lit(False))


def page_applies(cell: Column | str, pages: Column) -> Column:
    """A blank page cell applies to all pages; else one of its tokens (full-width separators folded) is asked for."""
    own = F.transform(tokens(F.translate(as_col(cell), "，；／", ",;/"), SEPARATORS["page"]), lambda t: F.lower(t))
    return (F.size(own) == 0) | F.coalesce(F.size(pages) == 0, F.lit(True)) | F.arrays_overlap(own, F.transform(pages, lambda p: F.lower(F.trim(p))))


def slot_parts(cell: Column | str) -> Column:
    """role, placement.role or placement.variant.role as (placement, variant, role); null where it is none of them."""
    parts = F.split(F.trim(as_col(cell)), r"\.")
    fine = F.size(parts).between(1, 3) & F.forall(parts, lambda p: p.rlike(r"^[A-Za-z0-9_-]+$"))
    at = lambda i: F.get(parts, i)
    n = F.size(parts)
    return F.when(fine, F.struct(F.when(n > 1, at(F.lit(0))).otherwise("").alias("placement"), F.when(n == 3, at(F.lit(1))).otherwise("").alias("variant"), at(n - 1).alias("role")))


def slot_key(placement: Column | str, variant: Column | str, role: Column | str) -> Column:
    """The parts composed again; blanks are left out."""
    return F.array_join(F.filter(F.array(*map(as_col, (placement, variant, role))), lambda p: F.coalesce(p, F.lit("")) != ""), ".")


def matches_all(equal: dict[str, str] | None = None, holds: dict[str, str] | None = None, begins: dict[str, str] | None = None, among: tuple[list[str], list[str]] | None = None) -> Column:
    """A conjunctive filter: equal, contained and leading text (letter case aside); among is (columns, values),
    of which any column has to hold any value."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    parts = [low(c) == v.strip().lower() for c, v in (equal or {}).items() if v.strip()]
    parts += [low(c).contains(v.strip().lower()) for c, v in (holds or {}).items() if v.strip()]
    parts += [low(c).startswith(v.strip().lower()) for c, v in (begins or {}).items() if v.strip()]
    if among and among[1]:
        hit = F.lit(False)
        for c in among[0]:
            hit = hit | F.upper(F.trim(F.col(c).cast("string"))).isin(*[v.strip().upper() for v in among[1]])
        parts.append(F.coalesce(hit, F.lit(False)))
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def all_if_none(matched: Column, *scope: str) -> Column:
    """Keep the rows that match, or all rows of the scope where none of them does. A window over the scope."""
    from pyspark.sql import Window as W

    return matched | (F.max(matched.cast("int")).over(W.partitionBy(*map(F.col, scope))) == 0)
