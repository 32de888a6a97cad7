"""Every registered query with an oracle text gives the oracle's rows."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_text_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).columns[:2] == ["data_aposta", "esporte"]
