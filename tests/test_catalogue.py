"""Every registered query against its SQL statement, on the smallest test tables."""

import pytest

import __spark_entry__ as entry_points
from tests import oracle
from weirgate.catalogue import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert oracle.compare(result, duck, ORACLE[name]) is None
    else:
        result.count()


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["id", "kind", "amount"]


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_points_hold_the_catalogue():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
