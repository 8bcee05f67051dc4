"""Every registered query equals its SQL twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect
from workload.queries import REGISTRY

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(REGISTRY) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    got, want, extra, missing = compare(queries()[name](spark, SF), con, oracle_sql()[name])
    assert (got, extra, missing) == (want, [], [])
    assert got > 0
