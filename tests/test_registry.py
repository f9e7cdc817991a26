"""Every registered query against its SQL, on the small tables."""

import pytest
from checks import compare, registry

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert sorted(registry.queries()) == sorted(registry.oracle_sql())
    assert registry.queries().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, sql, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = sql.execute(registry.oracle_sql()[name]).df()
    assert len(want) > 0
    assert compare.differences(got, want) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
