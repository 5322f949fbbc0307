"""Every named query against its DuckDB equivalent on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
import compare
from canvass.plans.registry import QUERIES
from oracles.queries import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.connection(FOLDER)


def test_names():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same, note = compare.compare(spark, con, FOLDER, name)
    assert same, note


def test_entry(spark):
    assert entry.entry(spark).columns == ["device_id", "user_property", "user_property_value"]
