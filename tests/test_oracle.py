"""Every registered query against its reference SQL, over whole tables."""

import pytest

import __spark_entry__ as driver
from castledger.plans import oracle, queries
from compare import connect, mismatch

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_reference(spark, duck, folder, name):
    assert mismatch(QUERIES[name](spark, folder), duck, ORACLE[name]) is None


def test_entry_point(spark):
    assert driver.entry(spark).count() == 83
