"""Every registered query against its DuckDB statement."""

import pytest
from compare import differences, entry, oracle_connection

from pairloom.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, sf, name):
    assert differences(spark, con, name, sf) == ""


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
