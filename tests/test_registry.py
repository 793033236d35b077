"""Every registered query against its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, duck_rows, spark_rows
from conftest import SMALL
from registry.oracles import all_oracles
from registry.spark_queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(duck, ORACLES[name])


def test_entry(spark):
    got = entry_point.entry(spark)
    assert got.columns == ["event_date", "event_type", "event_count"]
    assert got.count() > 0
