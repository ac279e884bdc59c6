"""Every query with an oracle agrees with it; every other query returns rows."""

import pytest

import __spark_entry__ as entry
from tests.conftest import ORACLE
from tests.oracle import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()
FITS = {name for name in QUERIES if name.startswith(("model_", "shapley_local", "shapley_additivity", "score_batch", "score_parity"))}


@pytest.fixture(scope="module")
def con():
    return connect(ORACLE)


def test_oracle_keys_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(name, spark, con):
    assert difference(QUERIES[name](spark, ORACLE), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - FITS))
def test_returns_rows(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 12
