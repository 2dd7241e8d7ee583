"""Every registered query with SQL: equal results on the given tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_result(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert differences(frame, duck, entry.oracle_sql()[name]) == []


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only(spark, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert frame.columns and frame.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "term"
