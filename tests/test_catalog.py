"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, sf_dir, name):
    problem, rows, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf_dir)
    assert problem is None
    assert rows > 0
