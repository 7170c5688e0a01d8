import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import compare, tables
from rivulet.plans.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    said = compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert said.startswith("ok"), said


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert duckdb.__version__
