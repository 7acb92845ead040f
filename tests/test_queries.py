import pytest
from compare import connect, difference

from tideline.catalog import QUERIES


@pytest.fixture(scope="module")
def sql(sample):
    with connect(sample) as con:
        yield con


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_its_sql(spark, sql, sample, name):
    assert difference(spark, sql, sample, QUERIES[name]) == ""


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
