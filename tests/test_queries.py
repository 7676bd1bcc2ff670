"""Every registered query against its DuckDB twin on the smallest data set."""

import compare
import pytest

import __spark_entry__ as entry_point
from trasvase.catalogue import QUERIES
from trasvase.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = entry_point.queries()[name](spark, FOLDER)
    assert compare.differences(found, con, entry_point.oracle_sql()[name]) == []
