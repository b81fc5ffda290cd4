"""Every query against its DuckDB SQL, at a small scale."""

from __future__ import annotations

import pytest
from compare import differences

from tessera.plans import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(spark, SF, catalog.queries()[name], catalog.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_line_changes_are_minimal(spark):
    """Against the plain table of common subsequences, document by document."""
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: (r.text or "").removesuffix("\n") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lines = {k: v.split("\n") if v else [] for k, v in text.items()}

    def common(a: list, b: list) -> int:
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j + 1], new[j], row[j] + (x == y)))
            row = new
        return row[-1]

    got = {int(r.key): (r.added, r.removed) for r in catalog.queries()["line_changes"](spark, sf).collect()}
    want = {k: (len(lines[k + 1]) - n, len(lines[k]) - n) for k in lines if k + 1 in lines for n in [common(lines[k], lines[k + 1])]}
    assert got == want


def test_stream_claims_equal_a_replay(spark):
    sf = "/root/testdata/sf0.001"
    held, n, claimed = {}, {}, {}
    for r in sorted(spark.read.parquet(f"{sf}/events.parquet").collect(), key=lambda r: (r.ts, str(r.user_id))):
        key, order = (r.event_type, str(r.user_id)), held.setdefault(r.event_type, [])
        n[key] = n.get(key, 0) + 1
        if key[1] not in order:
            held[r.event_type] = [*order, key[1]][-256:]
            claimed[key] = claimed.get(key, 0) + 1
    assert {(r.scope, r.id): (r.n, r.claimed) for r in catalog.queries()["stream_claims"](spark, sf).collect()} == {k: (v, claimed.get(k, 0)) for k, v in n.items()}


def test_search_forms_equal_plain_python(spark):
    import hashlib

    from tessera.functions.udfs import search_text

    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: hashlib.md5(search_text(r.text or "").encode()).hexdigest() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.norm for r in catalog.queries()["nfkc_norm"](spark, sf).collect()} == want
