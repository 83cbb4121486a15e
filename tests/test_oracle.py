"""Every registered query against its SQL twin, on the smallest driver tables."""

import os

import pytest

from starloom.suite import oracle_sql, queries
from tests.compare import database, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("key", sorted(queries()))
def test_query(spark, con, key):
    df = queries()[key](spark, SF_DIR)
    sql = oracle_sql().get(key)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["song_id", "title", "num_listens"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
