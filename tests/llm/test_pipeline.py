"""The pipeline's stages, each against its operator's own decisions."""

import corpus_pipeline

from conftest import SF001


def test_pipeline_runs_and_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names, kept = docs.columns, []
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF001)
        assert docs.columns == names, name
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.select("doc_id").collect()}
