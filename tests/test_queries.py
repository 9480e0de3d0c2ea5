"""Registered queries: contract, and every one of them against its SQL at the smallest scale."""

from collections import Counter

import pytest

import __spark_entry__ as entry_module
from check import compare, database
from sluice.queries.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(entry_module.queries())
    assert max(Counter(entry_module.queries().values()).values()) == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name).startswith("ok")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() > 0
