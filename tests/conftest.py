from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gainledger.plans.flows import Inputs, Scope  # noqa: E402
from gainledger.sources.schemas import SOURCES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gainledger-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def typed(value, kind):
    """Python value for a declared column: ISO text for dates, numbers for decimals."""
    if value is None:
        return None
    if kind.typeName() == "date":
        return day(value)
    if kind.typeName() == "decimal":
        return Decimal(str(value))
    return value


def frame(spark, schema, rows):
    """DataFrame of a declared schema; columns a row leaves out are null."""
    data = [tuple(typed(row.get(f.name), f.dataType) for f in schema.fields) for row in rows]
    return spark.createDataFrame(data, schema)


class FakeTables:
    """Source tables from rows; tables not given are empty."""

    def __init__(self, spark, cutover="2017-05-01", **rows):
        self.spark, self.cutover, self.rows = spark, cutover, rows

    def table(self, name):
        return frame(self.spark, SOURCES[name], self.rows.get(name, []))


@pytest.fixture
def run(spark):
    """Inputs of a run over hand-made rows."""

    def make(
        accounts=("A1",), codes0=("600000",), codes1=("000001",),
        start="2016-04-01", end="2017-04-01", cutover="2017-05-01", **rows,
    ):
        instruments = [("0", c) for c in codes0] + [("1", c) for c in codes1]
        scope = Scope(
            "b1",
            day(start),
            day(end),
            spark.createDataFrame([(a,) for a in accounts], "sec_acct string"),
            spark.createDataFrame(instruments, "exch string, sec_cde string"),
        )
        return Inputs(FakeTables(spark, cutover, **rows), scope)

    return make


MEASURES = ["buy_vol", "sal_vol", "buy_amt", "sal_amt", "tax_fee"]


def measures(df):
    """{(account, code): (buy_vol, sal_vol, buy_amt, sal_amt, tax)} as floats."""
    return {
        (r.sec_acct, r.sec_cde): tuple(float(r[m]) for m in MEASURES) for r in df.collect()
    }
