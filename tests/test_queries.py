"""Every registered query against its SQL counterpart."""

import pytest
from compare import connect, difference
from sensor_rows import SMALL

import __spark_entry__ as entry
from tidegauge import catalogue


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_each_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "end_ts", "avg_temp"]


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, connection, name):
    found = difference(spark, connection, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert not found
