"""Registered queries: oracle parity, contracts, and the pipeline on a small table."""

import pytest

import corpus_pipeline
from kempt.llm import queries
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    ours, theirs = compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLE[name], SF)
    assert ours[:3] == theirs[:3]


CONTRACT = {"op2": {"doc_id", "n_shingles", "component_id"},
            "op4": {"doc_id", "held_out", "score", "predicted"}, "op7": {"doc_id", "held_out", "score", "predicted"},
            "op9": {"doc_id", "start", "n_tokens", "ids_crc32"}, "op10": {"doc_id", "held_out", "lang_pred", "score"}}


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.split("_")[0] in CONTRACT])
def test_one_row_per_document(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert CONTRACT[name.split("_")[0]] <= set(out.columns)
    docs = queries.documents(spark, SF)
    assert out.count() == docs.count() and out.join(docs, "doc_id", "left_anti").count() == 0


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    docs = queries.documents(spark, SF)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
