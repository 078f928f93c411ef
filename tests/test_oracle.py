"""Every query with oracle SQL gives the same columns, types and rows."""

import pytest
from conftest import SF_DIR
from harness import differences, duck

import __spark_entry__ as contract

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(name, spark, con):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(name, spark):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns[:2] == ["source_name", "language"]
