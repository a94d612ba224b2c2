"""The pipeline's stages on empty tables, nulls, repeats and further columns."""

import tempfile

import pytest
from llm_cases import EDGES, frame, normal

import corpus_pipeline

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def empty_dir(spark):
    path = tempfile.mkdtemp(prefix="stockroom-empty-")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_an_empty_table(spark, empty_dir, name):
    docs = spark.read.parquet(f"{empty_dir}/documents.parquet")
    assert STAGES[name](spark, docs, empty_dir).count() == 0


def test_the_pipeline_on_an_empty_table(spark, empty_dir):
    got = corpus_pipeline.run(spark, empty_dir)
    assert got.count() == 0 and got.columns[:2] == ["doc_id", "n_tokens"]


def test_filters_carry_further_columns_and_keep_whole_rows(spark):
    docs = frame(spark, EDGES)
    rows = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and {(r["doc_id"], r["text"]) for r in got.collect()} <= rows, name


def test_repeats_and_nulls_in_exact_dedup(spark):
    kept = STAGES["exact_dedup"](spark, frame(spark, EDGES), SF).collect()
    assert sorted(normal(r["text"]) for r in kept) == sorted({normal(t) for _, t, *_ in EDGES})


def test_clean_texts_stay_in_decontamination_without_items(spark, empty_dir):
    docs = frame(spark, EDGES)
    assert STAGES["decontamination"](spark, docs, empty_dir).count() == len(EDGES)
