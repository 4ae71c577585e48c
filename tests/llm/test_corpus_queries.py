"""Registered corpus queries: oracle SQL at sf0.001, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gristmill.llm import queries

DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    rel = con.sql(queries.ORACLE[name])
    columns = rel.columns
    expected = sorted(tuple(map(str, r)) for r in rel.fetchall())
    got = queries.QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == expected


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_compose(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DIR)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        n = out.count()
        assert 0 < n <= rows
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            assert out.where("n_chars <> length(text)").count() == 0
        else:
            assert n == rows and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
        docs, rows = out, n
    whole = corpus_pipeline.run(spark, DIR)
    key = ["doc_id", "ids_sha256"]
    assert sorted(whole.select(key).collect()) == sorted(docs.select(key).collect())


def test_pipeline_on_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0
