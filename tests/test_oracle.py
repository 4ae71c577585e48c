"""Every SQL-expressible query against its DuckDB oracle at sf0.01, and every
model query for a non-empty, stable-schema result."""

import duckdb
import pytest

import __spark_entry__ as E
from gristmill.suite import QUERIES as SUITE
from oracle_check import TABLES, close, rows_of

from conftest import SF_SMALL

# the corpus operators have their own tests beside them
QUERIES = {n: q for n, q in E.queries().items() if n in SUITE}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in SUITE}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    sc, sr = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    rel = con.sql(ORACLE[name])
    dc, dr = rows_of(rel.columns, rel.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    bad = [(a, b) for a, b in zip(sr, dr) if not all(close(x, y) for x, y in zip(a, b))]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == QUERIES[name](spark, SF_SMALL).columns


def test_every_query_has_oracle_or_is_a_fit():
    fits = {"kmeans_label", "pca_project", "fit_gbt_regressor", "fit_gbt_classifier",
            "fit_multiclass", "two_stage_classify", "pseudo_label", "cv_score", "grid_search",
            "random_search", "fit_apply_model", "impute_model_rf"}
    assert set(QUERIES) - set(ORACLE) == fits


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
