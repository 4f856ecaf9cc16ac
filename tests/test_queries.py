import sys

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from lakeops.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_of_the_lakehouse_has_sql():
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    assert differences(df, duck, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert "lakeops" in sys.modules
