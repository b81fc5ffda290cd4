"""Queries of the subpackage against their SQL, where SQL can express them."""

from __future__ import annotations

import pytest
from compare import differences

from tessera.llm import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(spark, SF, catalog.queries()[name], catalog.oracle_sql()[name]) == []


def test_all_are_there():
    assert {q.split("_")[0] for q in catalog.queries()} == {f"op{n}" for n in range(1, 14)}
