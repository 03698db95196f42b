"""The pipeline's stages: what goes, what stays, on whole and on odd tables."""

import corpus_pipeline
from orgloom.llm import jaccard, pii
from orgloom.llm.common import table


def test_stages_on_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        ids, before = [r[0] for r in out.select("doc_id").collect()], {r[0] for r in docs.select("doc_id").collect()}
        assert set(ids) <= before and ids, name
        if name != "mix":
            assert out.columns == columns and len(ids) == len(set(ids)), name
        if name == "near_duplicates":
            again = jaccard.near_duplicates(out, 5, 80).collect()
            assert all(r.doc_id == r.component_id for r in again)
        if name == "personal_data":
            assert set(ids) == before
            assert not [r for r in out.select("text").collect() if pii.base_spans(r.text or "")]
        docs = out


def test_an_empty_table_passes_all_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
