import sys

import pytest
from compare import compare, connect

from wattlake.plans import load_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = load_queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_equal_those_of_the_sql(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name, QUERIES, SQL)
    assert ok, note


def test_entry_points(spark):
    sys.modules.pop("__spark_entry__", None)
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
