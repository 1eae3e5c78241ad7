"""Every registered query against its DuckDB oracle at sf0.001 (the
driver repeats this at sf0.01); oracle-less queries must run and return
rows with a stable schema."""

import pytest

import __spark_entry__ as se
from conftest import SMOKE_DIR
from oracle_harness import compare, duck

QUERIES = se.queries()
ORACLE = se.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    info = compare(spark, con, SMOKE_DIR, name, QUERIES[name], ORACLE[name])
    assert info["ok"], info


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    schema = df.schema
    assert df.count() > 0
    assert QUERIES[name](spark, SMOKE_DIR).schema == schema


def test_entry(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert {"mrr", "churn_probability", "revenue_at_risk"} <= set(df.columns)
