"""The registered queries: those with SQL against it, the pipeline stage by stage."""

import pytest
from oracle_check import connect, differences

import corpus_pipeline
from meterdw.llm import decontaminate, jaccard, secret_scan
from meterdw.llm.common import table
from meterdw.llm.oracle import SQL
from meterdw.llm.queries import QUERIES

FULL = {"op1_packing": "documents", "op2_sharding": "documents", "op4_quality": "documents",
        "op5_fingerprints": "documents", "op6_jaccard": "documents", "op7_warc": "pages", "op8_toxicity": "documents",
        "op9_page_text": "pages", "op10_secrets": "documents", "op11_token_counts": "documents",
        "op12_alignment": "documents", "op13_vector_codes": "embeddings"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), SQL[name]) == []


@pytest.mark.parametrize("name", sorted(FULL.keys() - SQL.keys()))
def test_every_row_is_there(spark, folder, name):
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(FULL[name], "doc_id")
    out = QUERIES[name](spark, folder).select(key).distinct()
    assert out.count() == table(spark, folder, FULL[name]).count()


def test_pipeline(spark, folder):
    docs = table(spark, folder, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).persist()
        assert docs.columns == seen[0].columns
        seen.append(docs)
    kept = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] == kept[4] and kept[0] != kept[1]
    classes = jaccard.classes(seen[2]).collect()
    assert all(r.component_id == r.doc_id for r in classes)
    assert decontaminate.find(seen[3], table(spark, folder, "benchmark")).isEmpty()
    left = secret_scan.find(seen[4]).where("exists(spans, s -> s.kind in ('access', 'hex'))")
    assert left.isEmpty()
    pieces = corpus_pipeline.STAGES[-1][1](spark, seen[4], folder)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept[4]
    assert corpus_pipeline.run(spark, folder).count() == pieces.count()
    for frame in seen[1:]:
        frame.unpersist()
