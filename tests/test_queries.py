"""Every registered query against its SQL twin."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402
from conftest import SMALL  # noqa: E402
from stockmart.queries.oracle import ORACLE  # noqa: E402
from stockmart.queries.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = check_oracle.compare(spark, con, SMALL, name)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
