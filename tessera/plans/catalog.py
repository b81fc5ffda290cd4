"""All queries over the reference operators, by name."""

from __future__ import annotations

from tessera.plans import aggregates, diffs, flows, lookups, pages, records, rules, texts, versions  # noqa: F401  each registers its queries
from tessera.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
