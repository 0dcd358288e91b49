"""Stages: columns, decisions that take effect, and the whole run."""

import corpus_pipeline
from sparkrank.llm import pii, simhash, toxicity
from sparkrank.llm.common import table


def test_stages(spark, sf_dir):
    docs = first = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.schema.names == first.schema.names, name
        assert [f.dataType for f in after.schema] == [f.dataType for f in first.schema], name
        kept, before = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            scored = toxicity.scored(docs, table(spark, sf_dir, "labels"))
            assert kept == {r.doc_id for r in scored.filter("predicted = 0").collect()}
        elif name == "simhash":
            assert kept == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        elif name == "pii":
            assert kept == before
            assert all(not pii.base_spans(r.text) for r in after.collect())
            assert after.filter("n_chars <> length(text)").count() == 0
        assert kept <= before
        docs = spark.createDataFrame(after.toPandas(), first.schema)
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept


def test_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert after.columns == docs.columns, name
            assert after.count() <= docs.count()
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0) == (docs.count() > 0)
