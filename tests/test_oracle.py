"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from workload.check import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_size", "word1", "word2", "word_count"]
    assert df.count() == 100
