"""The registered queries against their SQL, and the pipeline against brute force."""

import duckdb
import pytest
from llm_cases import linked_components, normal

import corpus_pipeline
from stockroom.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "labels", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert sorted(want.project(", ".join(columns)).fetchall()) == sorted(tuple(r[c] for c in columns) for r in got.collect())


def test_pipeline_matches_brute_force(spark):
    import tiktoken
    import public_tokenizers

    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {d: t for d, t in rows.items() if t and any(c.isalpha() for c in t)}
    last = {}
    for d, t in sorted(left.items()):
        last[normal(t)] = d
    left = {d: left[d] for d in last.values()}
    components = linked_components(list(left.items()), 5, 80)
    left = {d: t for d, t in left.items() if components[d] == d}
    left = {d: t for d, t in left.items() if not any(i in t for i in items)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(left)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.MULTI_RANKS), special_tokens={})
    for r in got:
        assert r["n_tokens"] == len(known.encode_ordinary(left[r["doc_id"]])) and bytes(r["decoded"]).decode() == left[r["doc_id"]]


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
