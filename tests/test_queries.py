"""Every registered query: equal to its SQL twin, or at least runs with rows."""

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_equals_sql(spark, sf, duck, name):
    got = driver.queries()[name](spark, sf).toPandas()
    assert difference(got, duck.execute(driver.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_runs(spark, sf, name):
    assert driver.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
