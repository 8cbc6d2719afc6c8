"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import oracle
from changeflow.queries import QUERIES

SF_DIR = os.environ.get("CHANGEFLOW_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, SF_DIR, QUERIES[name], con) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name].run(spark, SF_DIR).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
