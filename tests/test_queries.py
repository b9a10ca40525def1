"""Every registered query against its SQL on the smallest test data."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from oracle_check import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registered.BY_TABLES) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(registered.BY_TABLES))
def test_query(spark, duck, name):
    got = registered.queries()[name](spark, SF).toPandas()
    assert compare(got, duck.execute(registered.oracle_sql()[name]).fetch_df()) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
