"""Every registered query against its DuckDB twin (row count, columns and
order-insensitive values), on the small test data."""

import pytest

from __spark_entry__ import entry, oracle_sql
from vaultline.plans.catalog import QUERIES
from tests.harness import compare, duck
from tests.conftest import SF_SMALL

_con = None


def _duck():
    global _con
    if _con is None:
        _con = duck(SF_SMALL)
    return _con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert compare(spark, name, SF_SMALL, _duck(), verbose=False)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(oracle_sql()))
    assert missing == []


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert "txn_id" in df.columns
