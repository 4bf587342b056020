"""Every registered query against its SQL on the shared test tables."""

import os

import pytest

import __spark_entry__ as entry
from nightledger.plans.catalog import registered
from nightledger.plans.oracle import oracle_sql
from tests.oracle_check import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registered()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_training_lacks_sql():
    assert set(QUERIES) - set(SQL) == {"gbt_score", "grid_search"}
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(name, QUERIES[name], SQL[name], spark, FOLDER, con) is None


def test_training_gives_probabilities(spark):
    rows = QUERIES["gbt_score"](spark, FOLDER).collect()
    assert rows and all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_grid_search_logs_each_combination(spark):
    rows = QUERIES["grid_search"](spark, FOLDER).collect()
    assert sorted(r["depth"] for r in rows) == [3, 4, 5, 6]
    assert all(0.0 <= r["recall"] <= 1.0 for r in rows)


def test_entry_registers_everything():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
