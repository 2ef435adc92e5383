"""Every registered query against its check SQL on the smallest data."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import connect, difference
from tests.conftest import SMALL

SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_check_sql():
    assert set(entry_module._QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    result = entry_module.queries()[name](spark, SMALL).toPandas()
    assert difference(result, duck.execute(SQL[name]).df()) is None


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
