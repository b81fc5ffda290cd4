from __future__ import annotations

import corpus_pipeline
from tessera.llm import decontaminate, line_dedup, simhash, toxicity
from tessera.llm.common import table

SF = "/root/testdata/sf0.01"


def test_each_stage_does_what_it_says(spark):
    docs = table(spark, SF, "documents")
    index = toxicity.fit(docs, table(spark, SF, "labels"))
    clean = {r.doc_id for r in toxicity.scores(docs, index).where("predicted = 0").collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == clean
    lines = corpus_pipeline.drop_lines(spark, kept, SF)
    assert lines.columns == docs.columns and lines.schema == docs.schema
    assert lines.where("n_chars <> length(text)").count() == 0 and lines.count() == kept.count()
    assert lines.select("doc_id", "text").exceptAll(line_dedup.dedup_lines(kept).select("doc_id", "text")).count() == 0
    one = corpus_pipeline.drop_near_copies(spark, lines, SF)
    groups = simhash.near_duplicates(lines).select("component_id").distinct().count()
    assert one.columns == docs.columns and one.count() == groups
    free = corpus_pipeline.drop_leaks(spark, one, SF)
    bad = decontaminate.contamination(one, table(spark, SF, "benchmark")).where("contaminated").count()
    assert free.columns == docs.columns and free.count() == one.count() - bad
    mixed = corpus_pipeline.mix(spark, free, SF)
    assert mixed.count() == free.count() and mixed.where("taken > 2 * size").count() == 0


def test_run_is_the_stages_in_turn(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.exceptAll(corpus_pipeline.run(spark, "/root/testdata/sf0.001")).count() == 0
