"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks import oracles
from checks.compare import compare, connect
from checks.queries import REGISTRY

SF = entry_points.SMALL
QUERIES = REGISTRY
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_entry_points_name_every_query():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["tile", "band", "med", "qmin", "qmax"]
    assert df.count() > 0
