"""Every registered query runs on the small tables; those with SQL must give the same rows."""

import os

import pytest

import compare
from showroom.queries import all_queries, all_sql

FOLDER = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def engine():
    return compare.engine(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, engine, name):
    ok, text, _ = compare.compare(spark, engine, FOLDER, name, all_queries()[name], all_sql().get(name))
    assert ok is not False, text


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1500
    assert set(entry.oracle_sql()) <= set(entry.queries())
