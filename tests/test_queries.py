"""Every registered query against its SQL, and the entry point."""

import pytest

import __spark_entry__ as entry
from checks import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in entry.oracle_sql():
        assert compare(df, con, entry.oracle_sql()[name]) == ""
    else:
        assert len(df.collect()) > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
