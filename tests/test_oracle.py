"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as entry
import pytest

from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.filterwarnings("ignore:could not load")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, tables, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, FOLDER).count() > 0
    else:
        assert differences(query, sql, spark, FOLDER, tables) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["conv_id", "part", "text"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
