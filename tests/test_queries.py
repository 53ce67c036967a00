"""Every registered query against its SQL form, and the entry points."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from wardflow import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ALL))
def test_query(spark, con, name):
    rows, problem = compare(spark, con, FOLDER, registry.ALL[name])
    assert problem == ""
    assert rows > 0


def test_entry_points(spark):
    assert entry_points.entry(spark).count() == 65
    assert set(entry_points.oracle_sql()) < set(entry_points.queries())
    assert not [n for n in entry_points.queries() if n != n.lower()]
