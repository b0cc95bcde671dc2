from __future__ import annotations

import os

import duckdb
import pytest

from gainledger.operators.store import Workspace

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def work(spark):
    return Workspace(spark)


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    return FOLDER


@pytest.fixture(scope="session")
def engine(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return connection


DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, kept string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names clash."""

    def make(*rows):
        full = [(*r, *[None] * (4 - len(r)), 0, "x", "y") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
