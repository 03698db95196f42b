"""Every registered query against its SQL, at the smallest scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
