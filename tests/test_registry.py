"""Every registered query against its SQL on the given tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as registry
from compare import database, difference
from tickmart.registry.oracle import oracles
from tickmart.registry.queries import QUERIES

# the optional operators have tests of their own
BUILDS, SQLS = QUERIES, oracles()


@pytest.fixture(scope="module")
def db(sf):
    return database(sf)


def test_every_query_has_sql():
    assert set(BUILDS) == set(SQLS)
    assert BUILDS.items() <= registry.queries().items() and SQLS.items() <= registry.oracle_sql().items()


@pytest.mark.parametrize("name", list(BUILDS))
def test_query(spark, sf, db, name):
    message, rows = difference(spark, db, sf, BUILDS[name], SQLS[name])
    assert not message
    assert rows > 0


def test_entry(spark):
    top = registry.entry(spark)
    assert top.columns == ["symbol", "daily_high", "daily_low", "volatility_pct"]
    assert 0 < len(top.collect()) <= 5
