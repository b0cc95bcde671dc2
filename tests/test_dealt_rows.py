"""Runs over more instruments than a broadcast holds: rows are dealt by security once."""

from __future__ import annotations

import re
import time
from dataclasses import replace

import duckdb
import pytest
from conftest import measures
from test_rules import CLEARING, QUOTES, TRANSFER, flows_of, held, quote

from gainledger import oracle, queries
from gainledger.operators.sizing import INSTRUMENTS_A_TASK, shuffle_less, split_shuffles
from gainledger.operators.store import Workspace
from gainledger.plans import batch, flows, report, sse, szse
from gainledger.plans.valuation import holding_gap
from gainledger.sources.star_tables import VIEWS, StarTables

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]


@pytest.fixture
def hinted_only(spark):
    """Only what was counted as small is broadcast."""
    for name in NO_BROADCAST:
        spark.conf.set(name, "-1")
    shuffle_less(spark)
    yield
    for name in NO_BROADCAST:
        spark.conf.unset(name)


@pytest.fixture
def many(hinted_only, monkeypatch):
    """Every lookup counts as too large, so a run deals by security."""
    for module in (sse, batch, report):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    for module in (flows, batch, report):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df.hint("shuffle_hash"))


def by_security(inputs):
    """Few accounts, instruments beyond the bound."""
    scope = inputs.scope
    return replace(inputs, scope=replace(scope, by_security=True, accounts=scope.accounts.hint("broadcast")))


def plan_of(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())




def test_trades_are_shuffled_once_by_security(run, hinted_only):
    inputs = by_security(run(clr_stm_dtl=[CLEARING, CLEARING | dict(trad_date="2016-06-01")]))
    result = sse.trades(inputs)
    plan = plan_of(result)
    assert plan.count("hashpartitioning(sec_cde") == 2  # the lines and the instruments
    assert "hashpartitioning(sec_acct, sec_cde" not in plan
    assert measures(result) == {("A1", "600000"): (0, 200, 0, 2400, 6)}


def test_priced_rows_stay_where_their_security_is(run, hinted_only):
    inputs = run(
        accounts=("A1", "A2"), h_non_trad_tran=[TRANSFER, TRANSFER | dict(sec_cde=600001)],
        sec_quot=[quote("2016-05-03", 12.5)], codes0=("600000", "600001"),
    )
    result = sse.transfers(by_security(inputs))
    plan = plan_of(result)
    assert "hashpartitioning(sec_cde, day" not in plan and "hashpartitioning(sec_acct, sec_cde" not in plan
    assert measures(result) == measures(sse.transfers(inputs)) != {}


def test_the_gap_takes_its_prices_from_the_boundary(run, spark):
    inputs = run(hold_his=held(100, 250), sec_quot=QUOTES)
    boundary = spark.createDataFrame(
        [("0", "A1", "600000", 10, 12, 100, 250), ("0", "A1", "600001", 10, 12, None, 1)],
        "exch string, sec_acct string, sec_cde string, start_prc int, end_prc int, start_vol int, end_vol int",
    )
    result = holding_gap(replace(inputs, shared={"boundary": boundary}), flows_of(spark, 100), "0")
    assert "Join" not in result._jdf.queryExecution().optimizedPlan().toString()
    assert measures(result) == measures(holding_gap(inputs, flows_of(spark, 100), "0"))
    assert measures(result) == {("A1", "600000"): (50, 0, 600, 0, 0)}


def test_holdings_are_dealt_once_and_equal_their_sql(spark):
    tables = StarTables(spark, FOLDER)
    found = tables.table("hold_his")
    assert plan_of(found).count("Exchange hashpartitioning") == 1
    plain = spark.sql(VIEWS["hold_his"], line=tables.table("line"))
    assert found.dtypes == plain.dtypes and found.count() == plain.count() > 0
    assert found.exceptAll(plain).isEmpty()


def test_stored_lines_have_folders_and_all_rows(spark):
    tables = StarTables(spark, FOLDER)
    stored = tables.with_stored_lines(Workspace(spark))
    lines, plain = stored.table("line"), tables.table("line")
    assert sorted(lines.dtypes) == sorted(plain.dtypes)
    lines = lines.select(*plain.columns)
    assert lines.exceptAll(plain).isEmpty() and plain.exceptAll(lines).isEmpty()
    plan = plan_of(stored.table("h_non_trad_tran"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "= 0" in filters and "= R" in filters


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name)
    rows = spark.range(10_000).selectExpr("id % 5000 AS k").groupBy("k").count()
    stored = Workspace(spark, tidy=True).store(rows, "counts")
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(name) == setting
    assert stored.count() == 5000


@pytest.mark.parametrize("name", ["q_commission", "q_ledger_all", "q_profit", "q_final_report"])
def test_whole_runs_dealt_by_security(spark, many, name):
    engine = duckdb.connect()
    for table in ("customer", "supplier", "part", "orders", "lineitem", "events"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = engine.execute(oracle.statement(name)).fetchdf()
    columns = sorted(expected.columns)
    result = queries.QUERIES[name](spark, FOLDER).toPandas()
    frames = [f[columns].sort_values(columns).reset_index(drop=True).astype(str) for f in (expected, result)]
    assert len(expected) > 0 and frames[0].equals(frames[1])


def test_changes_dealt_by_security(run, many):
    from test_rules import OLD

    inputs = run(s_shdr_hld_chg=[OLD | dict(chg_cde="A0A", chg_vol=70), OLD | dict(chg_cde="A0A", chg_vol=-30)])
    assert measures(szse.transfers(by_security(inputs))) == {("A1", "000001"): (70, 30, 0, 0, 0)}


def test_rules_and_boundary_read_their_own_holdings(spark):
    """A day asked for twice has both marks; held days are split by what asked for them."""
    days = "exch string, sec_cde string, ask_date string"
    events = spark.createDataFrame([("0", "600000", "2016-05-03"), ("0", "600000", "2016-06-01")], days)
    bounds = spark.createDataFrame([("0", "600000", "2016-05-03"), ("0", "600000", "2017-04-01")], days)
    asks = batch.marked_asks(events, bounds)
    found = {r.ask_date: (r.at_event, r.at_bound) for r in asks.collect()}
    assert found == {"2016-05-03": (True, True), "2016-06-01": (True, False), "2017-04-01": (False, True)}
    assert flows.marked(asks, flows.AT_EVENT).columns == ["exch", "sec_cde", "ask_date"]
    assert {r.ask_date for r in flows.marked(asks, flows.AT_BOUND).collect()} == {"2016-05-03", "2017-04-01"}
    assert flows.marked(events, flows.AT_EVENT) is events


def test_shuffles_are_split_by_the_number_of_instruments(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        split_shuffles(spark, 4 * INSTRUMENTS_A_TASK)
        assert spark.conf.get(name, None) is None  # as many parts as the session has
        split_shuffles(spark, 20 * INSTRUMENTS_A_TASK + 1)
        assert spark.conf.get(name) == "21"
        split_shuffles(spark, 5 * INSTRUMENTS_A_TASK)
        assert spark.conf.get(name) == "21"
    finally:
        spark.conf.unset(name)
