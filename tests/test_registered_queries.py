"""Each registered query against its DuckDB twin on the smallest data set."""

import pytest

from __spark_entry__ import oracle_sql, queries
from checks import CHECKS
from checks.compare import differences, duckdb_connection

SMALL = "/root/testdata/sf0.001"
TWINS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL)


@pytest.mark.parametrize("name", list(TWINS))
def test_query_equals_its_twin(spark, con, name):
    assert differences(queries()[name](spark, SMALL), con, TWINS[name]) is None


def test_every_query_of_the_jobs_has_a_twin():
    assert not [name for name, (_, sql) in CHECKS.items() if sql is None]
