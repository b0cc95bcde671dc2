"""Every registered query against its check SQL, on the smallest given tables."""

from __future__ import annotations

import functools
import os

import duckdb
import pytest

import gainledger.queries as registry
from gainledger import oracle

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def one_ledger_for_all():
    """The queries over one ledger differ only in what they do with it."""
    make = registry._with_ledger
    whole = functools.cache(lambda spark, folder, exchanges: make(spark, folder, list(exchanges)))
    registry._with_ledger = lambda spark, folder, exchanges=registry.EXCHANGES: whole(spark, folder, tuple(exchanges))
    yield
    registry._with_ledger = make


def test_every_query_has_check_sql():
    assert set(oracle.FINAL) == set(registry.QUERIES)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, engine, name):
    expected = engine.execute(oracle.statement(name)).fetchdf()
    columns = sorted(expected.columns)
    result = registry.QUERIES[name](spark, FOLDER).toPandas()
    assert sorted(result.columns) == columns
    expected = expected[columns].sort_values(columns).reset_index(drop=True)
    result = result[columns].sort_values(columns).reset_index(drop=True)
    assert len(expected) > 0
    assert expected.astype(str).equals(result.astype(str))
