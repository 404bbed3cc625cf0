"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from oracle import compare, duck

from __spark_entry__ import entry
from feedloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    _, _, problem = compare(spark, connection, name, QUERIES[name], ORACLES.get(name), SF)
    assert problem is None, problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
