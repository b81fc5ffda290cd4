from __future__ import annotations

from tessera.operators import diff


def test_trees_nested_deep_do_not_fail_the_job(spark):
    deep, over = '{"a":' * 500 + "1" + "}" * 500, "[" * 100_000 + "]" * 100_000
    rows = {r.key: (r.path, r.value) for r in diff.tree_paths(spark.createDataFrame([("d", deep), ("o", over)], "k string, t string"), "k", "t").collect()}
    assert rows["d"] == ("/a" * 500, "1") and rows["o"][0] == "" and rows["o"][1].startswith('"[[')
