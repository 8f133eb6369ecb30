"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as registry
from tests.oracle_check import differences, oracle_connection
from workload.oracle import all_oracles
from workload.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_of_the_library_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, connection, name):
    result = registry.queries()[name](spark, SF_DIR)
    assert differences(result, connection, registry.oracle_sql()[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0
