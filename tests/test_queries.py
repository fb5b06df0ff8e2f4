"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from workload.queries import all_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


# Queries of the optional package have tests of their own.
OWN = sorted(all_queries())


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(OWN) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    result = queries()[name](spark, SF)
    if name not in oracle_sql():
        assert result.count() > 0
        return
    assert check.compare(result, con, oracle_sql()[name]) is None
