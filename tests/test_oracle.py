"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

from costmart.catalog import ORACLE_SQL, QUERIES

from .compare import canon, duck, run_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    dcols, drows = run_sql(con, ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(df.columns, [tuple(r) for r in rows]) == canon(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_queries_run(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
