"""The paths taken when a lookup side is too large to broadcast, and hot keys."""

from __future__ import annotations

from dataclasses import replace

import pytest
from conftest import measures
from test_rules import CALENDAR, CLEARING, HOLDING, LINE, OLD, QUOTES, TRANSFER, held, quote

from gainledger.operators import sizing
from gainledger.operators.sizing import broadcast_if_small, fits_broadcast
from gainledger.plans import batch, flows, report, sse, szse


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Every lookup counts as too large, for our own check and for the planner."""
    monkeypatch.setattr(sse, "fits_broadcast", lambda df: False)
    for module in (flows, batch, report):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(report, "fits_broadcast", lambda df: False)
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin"), plan.count("NestedLoop")


def test_size_check(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)
    keys = spark.range(11).withColumnRenamed("id", "k")
    facts = spark.range(100).selectExpr("id % 20 AS k")
    plan = facts.join(broadcast_if_small(keys, 11), "k")._jdf.queryExecution().optimizedPlan()
    assert "strategy=broadcast" in plan.toString()
    plan = facts.join(broadcast_if_small(keys, 10), "k")._jdf.queryExecution().optimizedPlan()
    assert "strategy=broadcast" not in plan.toString()
    assert sizing.BROADCAST_ROWS <= 1_000_000


def test_counted_universes_filter_before_the_exchange(run):
    """Semi joins written after a sum end up below it when their side was counted as small."""
    inputs = run(clr_stm_dtl=[CLEARING])
    sets = {n: broadcast_if_small(getattr(inputs.scope, n)) for n in ("accounts", "instruments")}
    counted = flows.Inputs(inputs.tables, replace(inputs.scope, **sets))

    def optimized(some_inputs):
        plan = sse.trades(some_inputs)._jdf.queryExecution().optimizedPlan().toString()
        return plan.index("Aggregate"), plan.index("LeftSemi")

    total, semi = optimized(counted)
    assert total < semi  # the sum is the outer operator
    total, semi = optimized(inputs)
    assert semi < total  # of unknown size: joined after the sum


def test_trades_without_broadcast(run, no_broadcast):
    lender = dict(acct_sort="RQ", sec_setl_acct="A1", s_date="2016-05-01", e_date="2016-09-01")
    lines = [CLEARING | dict(trad_date="2016-08-31"), CLEARING | dict(trad_date="2016-09-01")]
    inputs = run(clr_stm_dtl=lines * 50, stm_acct_setup_his=[lender])
    result = sse.trades(inputs)
    sort_merge, broadcast, nested = joins(result)
    assert sort_merge >= 3 and broadcast == 0 and nested == 0
    assert measures(result) == {("A1", "600000"): (0, 5000, 0, 60000, 150)}


def test_hot_trade_number_costs_no_pairs(run, no_broadcast):
    """Two thousand equal trades against as many clearing lines: four million pairs, not built."""
    trade = dict(
        trad_nbr=1, trad_date="2016-05-03", sec_cde=600000, b_shr_acct="E1", buy_aply_nbr="1",
        sal_shdr_acct="A1", sal_aply_nbr="1", memo="50",
    )
    inputs = run(accounts=("E1",), h_sec_trad=[trade] * 2000, clr_stm_dtl=[CLEARING] * 2000)
    assert measures(sse.margin_trades(inputs)) == {
        ("E1", "600000"): (0, 100 * 4_000_000, 0, 1200 * 4_000_000, 3 * 4_000_000)
    }


def test_few_orders_filter_the_clearing_lines_before_the_sum(run):
    trade = dict(
        trad_nbr=1, trad_date="2016-05-03", sec_cde=600000, b_shr_acct="E1", buy_aply_nbr="1",
        sal_shdr_acct="A1", sal_aply_nbr="1", memo="50",
    )
    inputs = run(accounts=("E1",), h_sec_trad=[trade], clr_stm_dtl=[CLEARING, CLEARING | dict(trad_nbr=2)])
    result = sse.margin_trades(inputs)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    cleared = plan[plan.index("trad_date") :]
    assert cleared.rindex("Aggregate") < cleared.rindex("LeftSemi")
    assert measures(result) == {("E1", "600000"): (0, 100, 0, 1200, 3)}


def test_report_flags_without_broadcast(run, no_broadcast):
    from test_report import ACCOUNT

    account = ACCOUNT | dict(sec_acct="A1")
    inputs = run(
        intg_sec_acct=[account, account | dict(mkt_sort="1", cert_nbr="ID000009", oap_acct_nbr="O9")],
        hold_his=[HOLDING],
        szse_excut_info=[dict(comp_cde="000001", cert_nbr="ID000009 ")],
    )
    assert [tuple(r) for r in report.executives(inputs).collect()] == [("O9", "000001")]
    owners = inputs.tables.table("intg_sec_acct").select("oap_acct_nbr").distinct()
    assert [tuple(r) for r in report.top_holder_flags(inputs, only=owners).collect()] == [("O1", "600000")]


def test_hot_conversion_number(run, no_broadcast):
    bond = LINE | dict(cap_type="GZ", trans_type="00Y", trad_dirc="S", sec_cde=110001)
    stock = LINE | dict(cap_type="PT", trans_type="00Y", trans_vol=50, tran_prc=8)
    inputs = run(h_sec_tran=[bond] * 500 + [stock] * 500)
    assert measures(sse.conversion(inputs)) == {("A1", "600000"): (50 * 250_000, 0, 400 * 250_000, 0, 0)}


def test_other_rules_without_broadcast(run, no_broadcast):
    issue = dict(stk_cde="600000", list_date="2016-05-03", sec_exch_cde="0", iss_prc=8.5)
    inputs = run(
        accounts=("A1", "A2"),
        h_non_trad_tran=[TRANSFER],
        sec_quot=[quote("2016-05-03", 12.5), quote("2016-05-03", 2, "000001", "1")],
        ipo_iss_info=[issue],
        tdsum_date_exchange=CALENDAR,
        hold_his=[HOLDING],
        s_shdr_hld_chg=[OLD | dict(chg_cde="A88", chg_vol=8)],
    )
    assert measures(sse.transfers(inputs)) == {
        ("A1", "600000"): (0, 100, 0, 1250, 6),
        ("A2", "600000"): (100, 0, 1250, 0, 0),
    }
    assert measures(sse.ipo(inputs)) == {("A1", "600000"): (1000, 0, 8500, 0, 0)}
    assert measures(szse.fund_units(inputs)) == {("A1", "000001"): (8, 0, 16, 0, 0)}


def test_gap_without_broadcast(run, spark, no_broadcast):
    from test_rules import flows_of

    from gainledger.plans.valuation import holding_gap

    inputs = run(hold_his=held(100, 250), sec_quot=QUOTES)
    assert measures(holding_gap(inputs, flows_of(spark, 100), "0")) == {("A1", "600000"): (50, 0, 600, 0, 0)}


def test_large_lookups_are_hashed_and_nothing_is_sorted(spark):
    keys = spark.range(11).withColumnRenamed("id", "k")
    facts = spark.range(100).selectExpr("id % 20 AS k")
    plan = facts.join(broadcast_if_small(keys, 10), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=shuffle_hash" in plan


def test_boundary_values_sum_a_holding_once(run):
    """One row per security with both ends; the same from the holdings and from a run's stored ones."""
    from gainledger.plans.valuation import boundary_asks, boundary_holdings, boundary_values, run_bounds

    later = HOLDING | dict(sec_acct_nbr="A2", td_end_hold_vol=None, s_date="2016-01-01", e_date="2016-07-01")
    once = HOLDING | dict(sec_cde="600001", td_end_hold_vol=7)
    one_day = [quote("2016-05-03", 3, "600001")]
    inputs = run(accounts=("A1", "A2"), codes0=("600000", "600001"), hold_his=[HOLDING, later, once], sec_quot=QUOTES + one_day)
    plan = boundary_values(inputs)._jdf.queryExecution().optimizedPlan().toString()
    assert "ask_date" not in plan and plan.count("td_end_hold_vol") > 0
    stored = replace(inputs, shared={"held": inputs.held_on(boundary_asks(run_bounds(inputs)))})
    rows = boundary_holdings(inputs)
    assert rows.dtypes == boundary_holdings(stored).dtypes
    assert sorted(map(str, rows.collect())) == sorted(map(str, boundary_holdings(stored).collect()))
    assert {r.sec_cde for r in rows.collect()} == {"600000", "600001"}


def test_merged_tasks_are_bounded_and_a_lower_bound_is_kept(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        sizing.bound_tasks(spark)
        assert spark.conf.get(name) == f"{sizing.TASK_BYTES}b" and sizing.TASK_BYTES <= 16 << 20
        spark.conf.set(name, "8m")
        sizing.bound_tasks(spark)
        assert spark.conf.get(name) == "8m"
    finally:
        spark.conf.set(name, before)


def test_a_run_makes_its_lines_and_its_boundary_once(spark):
    from gainledger import queries
    from gainledger.plans.valuation import boundary_values

    inputs, _ = queries._with_ledger(spark, "/root/testdata/sf0.001", ["1"])
    for name in ("clr_stm_dtl", "s_stk_chg", "hold_his", "sec_quot"):
        files = inputs.table(name).inputFiles()
        assert files and not any("lineitem" in f for f in files)
    plan = boundary_values(inputs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_report_rows_meet_their_accounts_without_a_shuffle(run, spark):
    from test_report import ACCOUNT
    from test_rules import flows_of

    inputs = run(intg_sec_acct=[ACCOUNT | dict(sec_acct="A1")], hold_his=[HOLDING], sec_quot=QUOTES)
    plan = report.final_report(inputs, flows_of(spark, 100), 0)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("is_flow")]
    assert above.count("Join") == 2 and above.count("rightHint=(strategy=broadcast)") >= 1
