"""The corpus pipeline, stage by stage on its own input and as a whole."""

import corpus_pipeline
from strata.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = table(spark, SF, "documents")
    more = spark.createDataFrame([(10 ** 6, "the door opens with password=abc123xyz on weekdays", "en", "src0", 50)], docs.schema)
    docs = docs.unionByName(more)
    rows = {r["doc_id"]: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    known = steps["language_id"](spark, docs, SF)
    assert known.columns == docs.columns
    assert {r["doc_id"] for r in known.collect()} == {i for i, r in rows.items() if any(map(str.isalpha, r["text"] or ""))}
    once = steps["simhash_near_dedup"](spark, known, SF)
    assert once.columns == docs.columns and once.select("doc_id").distinct().count() == once.count() < len(rows)
    clean = steps["secret_scan"](spark, once, SF)
    assert clean.columns == docs.columns and clean.count() == once.count()
    changed = {r["doc_id"] for r in clean.collect() if r["text"] != rows[r["doc_id"]]["text"]}
    assert 10 ** 6 in changed and all("[SECRET]" in r["text"] for r in clean.collect() if r["doc_id"] in changed)
    mixed = steps["source_mix"](spark, clean, SF)
    assert mixed.columns == docs.columns and mixed.count() > clean.count()


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and out.count() > 0
    ends = out.groupBy("sequence_id").sum("length").collect()
    assert max(r["sum(length)"] for r in ends) <= 1024


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
