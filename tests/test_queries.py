"""Every registered query against its SQL, all rows, exactly."""

import pytest
from compare import differences, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries

ORACLE = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
