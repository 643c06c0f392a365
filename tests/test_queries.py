"""Every registered query against its SQL; those without SQL must give rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, duck

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, sf, connection, name):
    df = queries()[name](spark, sf)
    if name in ORACLES:
        assert compare(df, connection, ORACLES[name]) == []
    else:
        assert df.limit(1).count() == 1


def test_entry(spark):
    rows = entry(spark).collect()
    assert {r.model for r in rows} == {"champion", "challenger"}


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(queries())
