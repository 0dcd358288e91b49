"""Every registered query against its SQL statement on the smallest tables."""

import pytest

import __spark_entry__ as entry
from sparkrank.catalog.queries import QUERIES
from tools.check import connect, differences


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    assert differences(spark, db, name, sf_dir) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "precision", "recall", "map"]
