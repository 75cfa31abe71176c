"""Every registered query against its SQL twin."""

import pytest

import oracle
from workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle.duck(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    assert name in ORACLES
    assert oracle.compare(spark, con, sf, name) == ""


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
