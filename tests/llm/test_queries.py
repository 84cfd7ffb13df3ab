"""Registered queries against their DuckDB statements; contracts of the others."""

import pytest

import corpus_pipeline
from daymark.llm.oracles import ORACLES
from daymark.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.duck import assert_equal, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert_equal(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name])


CONTRACTS = {
    "op2_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op4_backoff_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_pairwise_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_id_planes": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == CONTRACTS[name]
    assert df.select("doc_id").distinct().count() == 200


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SMALL).cache()
        assert done.columns == docs.columns and done.dtypes == docs.dtypes
        assert 0 < done.count() <= docs.count()
        assert done.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
        docs = done
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()


def test_stages_take_odd_and_empty_documents(spark):
    from tests.llm.odd import odd_rows

    rows = [(i, t, "en", None, None) for i, t in odd_rows()]
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert docs.count() >= 0


def test_near_copies_leave_one(spark):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [(3, text), (5, text), (4, text.replace("word7 ", "other ")), (9, "clean and short"), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()) == [1, 2, 3, 9]
