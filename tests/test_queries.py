"""Every registered query against its SQL, on the smallest given tables."""

from pathlib import Path

import pytest

from verification.check import compare, oracle_connection
from verification.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
