"""Report attributes, flags and totals on hand-made rows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_rules import CALENDAR, HOLDING, LINE, NEW, OLD, QUOTES, flows_of, held

from gainledger.plans.report import (
    LITERAL,
    PER_SECURITY,
    classes_at_end,
    executives,
    final_report,
    latest_accounts,
    top_holder_flags,
    top_holders,
    unlocked_holders,
)
from gainledger.plans.valuation import holding_gap

ACCOUNT = dict(
    sec_acct="A1", sec_acct_sort="1", mkt_sort="0", sec_acct_name="first", cert_nbr="ID000001",
    oap_acct_nbr="O1", s_date="2010-01-01", e_date="3000-12-31",
)
CLASS = dict(
    oap_acct_nbr="O1", sec_acct_nbr="A1", clsf_2="28", clsf_3="2810", s_date="2010-01-01", e_date="3000-12-31"
)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_latest_account_and_class(run):
    history = [
        ACCOUNT | dict(e_date="2016-04-01", sec_acct_name="old"),
        ACCOUNT | dict(s_date="2016-05-01", e_date="2016-06-01", sec_acct_name="mid"),
        ACCOUNT | dict(s_date="2016-06-01", sec_acct_name="new"),
    ]
    classes = [CLASS | dict(e_date="2017-04-01"), CLASS | dict(s_date="2017-04-01", clsf_3="1110")]
    inputs = run(intg_sec_acct=history, invst_clsf_his=classes)
    assert rows(latest_accounts(inputs), "sec_acct", "sec_acct_name") == [("A1", "new")]
    assert rows(classes_at_end(inputs), "sec_acct", "clsf_3") == [("A1", "1110")]


def test_tied_versions_must_agree(run):
    same = run(intg_sec_acct=[ACCOUNT, ACCOUNT | dict(e_date="2018-01-01")])
    assert rows(latest_accounts(same), "sec_acct", "sec_acct_name") == [("A1", "first")]
    tied = run(intg_sec_acct=[ACCOUNT, ACCOUNT | dict(sec_acct_name="second")])
    with pytest.raises(Exception, match="versions tied on their start: sec_acct A1"):
        latest_accounts(tied).collect()


@pytest.mark.parametrize("attributes", [latest_accounts, classes_at_end])
def test_histories_are_filtered_before_they_are_grouped(run, attributes):
    other = dict(sec_acct="A2", sec_acct_name="else"), dict(sec_acct_nbr="A2", clsf_3="1110")
    inputs = run(intg_sec_acct=[ACCOUNT, ACCOUNT | other[0]], invst_clsf_his=[CLASS, CLASS | other[1]])
    found = attributes(inputs, of_run=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    history = plan.index("Join LeftSemi")
    assert "Aggregate" in plan[:history] and "Join" not in plan[:history]
    wanted = {r.sec_acct for r in inputs.scope.accounts.collect()}
    assert {r.sec_acct for r in found.collect()} == {"A1", "A2"} & wanted


def test_overlapping_classes_must_agree(run):
    same = run(invst_clsf_his=[CLASS, CLASS | dict(s_date="2012-01-01")])
    assert rows(classes_at_end(same), "sec_acct", "clsf_3") == [("A1", "2810")]
    other = run(invst_clsf_his=[CLASS, CLASS | dict(clsf_3="1110")])
    with pytest.raises(Exception, match="overlapping classes: sec_acct A1"):
        classes_at_end(other).collect()


def test_blank_owners_share_their_flags(run):
    """As in the source system: accounts without an owner count as one owner."""
    accounts = [ACCOUNT | dict(oap_acct_nbr=""), ACCOUNT | dict(sec_acct="A2", oap_acct_nbr="")]
    inputs = run(intg_sec_acct=accounts, h_dse_trad_lmt=[dict(shdr_acct="A1", sec_cde=600000)])
    assert rows(executives(inputs), "oap_acct_nbr", "sec_cde") == [("", "600000")]


def test_only_increases_with_a_released_key_are_exchanged(run):
    """The keys of the decreases filter the increases below the final exchange."""
    from gainledger.plans.szse import UNLOCK_CODE

    released = OLD | dict(chg_cde=UNLOCK_CODE, chg_vol=-5, stk_chrc="01")
    changes = [released, OLD | dict(chg_vol=5)] + [OLD | dict(chg_vol=7)] * 50
    info = dict(mkt_sort="1", sec_cde="000001", mkt_lvl_sort="1", sec_ctg="11", s_date="2000-01-01", e_date="3000-12-31")
    inputs = run(s_shdr_hld_chg=changes, sec_info=[info], tdsum_date_exchange=CALENDAR)
    found = unlocked_holders(inputs)
    assert rows(found, "exch", "sec_acct", "sec_cde") == [("1", "A1", "000001")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_executives_from_both_exchanges(run):
    accounts = [
        ACCOUNT,
        ACCOUNT | dict(sec_acct="01", mkt_sort="1", oap_acct_nbr="O2", cert_nbr="ID000002"),
        ACCOUNT | dict(sec_acct="02", mkt_sort="1", oap_acct_nbr="O3", cert_nbr="SHORT"),
        ACCOUNT | dict(sec_acct="03", mkt_sort="1", oap_acct_nbr="O4", cert_nbr="ID000002", sec_acct_sort="2"),
    ]
    inputs = run(
        intg_sec_acct=accounts,
        h_dse_trad_lmt=[dict(shdr_acct="A1", sec_cde=600000)] * 2,
        szse_excut_info=[
            dict(comp_cde="000001  ", cert_nbr="ID000002   "),
            dict(comp_cde="000001", cert_nbr="SHORT  "),
        ],
    )
    assert rows(executives(inputs), "oap_acct_nbr", "sec_cde") == [("O1", "600000"), ("O2", "000001")]


def test_unlocked_holders_window_and_pairs(run):
    info = dict(
        mkt_sort="0", sec_cde="600000", mkt_lvl_sort="1", sec_ctg="11", s_date="2010-01-01", e_date="3000-12-31"
    )
    sold = LINE | dict(trad_dirc="S", trans_type="00G", shdr_acct="A1")
    freed = OLD | dict(chg_cde="A51", chg_vol=70)
    locked = OLD | dict(chg_cde="A50", chg_vol=-70, stk_chrc="01")
    inputs = run(
        accounts=("A1", "A2", "A3"),
        sec_info=[info, info | dict(mkt_sort="1", sec_cde="000001")],
        tdsum_date_exchange=CALENDAR,  # the window starts on 2015-04-01
        h_sec_tran=[
            sold | dict(trad_date="2015-04-01"),
            sold | dict(shdr_acct="A2", trad_date="2015-03-31"),
            sold | dict(shdr_acct="A3", equt_type="HL"),
        ],
        s_shdr_hld_chg=[
            locked, freed, freed,
            locked | dict(shdr_acct="A2"), freed | dict(shdr_acct="A2", chg_vol=69),
            locked | dict(shdr_acct="A3"), freed | dict(shdr_acct="A3", seat_cde="other"),
        ],
    )
    assert rows(unlocked_holders(inputs), "exch", "sec_acct") == [("0", "A1"), ("1", "A1")]


def test_unlocked_holders_new_generation(run):
    info = dict(
        mkt_sort="1", sec_cde="000001", mkt_lvl_sort="3", sec_ctg="11", s_date="2010-01-01", e_date="3000-12-31"
    )
    locked = NEW | dict(chg_cde="A50", chg_vol=-30, stk_chrc="01")
    inputs = run(
        start="2017-01-01", end="2018-01-01", sec_info=[info],
        tdsum_date_exchange=[dict(calendar_date="2015-12-31", is_trd_dt="1")],
        s_stk_chg=[locked, NEW | dict(chg_cde="A51", chg_vol=30)],
    )
    assert rows(unlocked_holders(inputs), "exch", "sec_acct") == [("1", "A1")]


def test_top_ten_modes(run):
    owners = [
        ACCOUNT | dict(sec_acct=f"A{i}", oap_acct_nbr=f"O{i:02}") for i in range(12)
    ]
    positions = [HOLDING | dict(sec_acct_nbr=f"A{i}", td_end_hold_vol=100 + i) for i in range(12)]
    positions[0] |= dict(e_date="2016-04-01")  # ends on the start date: literal mode only
    inputs = run(intg_sec_acct=owners, hold_his=positions)
    assert len(rows(top_holder_flags(inputs, LITERAL), "oap_acct_nbr")) == 12
    largest = rows(top_holder_flags(inputs, PER_SECURITY), "oap_acct_nbr")
    assert largest == [(f"O{i:02}",) for i in range(2, 12)]


def test_top_holders_against_brute_force(spark):
    draw = random.Random(7)
    data = [(f"S{s}", f"O{o}", draw.randint(1, 12)) for s in range(4) for o in range(40)]
    frame = spark.createDataFrame(data, "sec_cde string, oap_acct_nbr string, hold_vol long")
    got = rows(top_holders(frame), "sec_cde", "oap_acct_nbr", "rank_1")
    expected = []
    for code, owner, volume in data:
        rank = 1 + sum(1 for c, _, v in data if c == code and v > volume)
        if rank <= 10:
            expected.append((code, owner, rank))
    assert got == sorted(expected)


@pytest.fixture
def report_row(run, spark):
    inputs = run(
        hold_his=held(200, 300), sec_quot=QUOTES, intg_sec_acct=[ACCOUNT], invst_clsf_his=[],
        tdsum_date_exchange=CALENDAR, h_dse_trad_lmt=[dict(shdr_acct="A1", sec_cde=600000)],
    )
    flows = flows_of(spark, 100, 50).withColumns(
        {
            "buy_amt": F.lit(1000).cast("decimal(18,2)"),
            "sal_amt": F.lit(600).cast("decimal(18,2)"),
            "tax_fee": F.lit(3).cast("decimal(18,3)"),
        }
    )
    ledger = flows.unionByName(holding_gap(inputs, flows, "0"))
    [row] = final_report(inputs, ledger, Decimal("0.002")).collect()
    return row


def test_report_values(report_row):
    r = report_row
    assert (float(r.start_hld_mkt_val), float(r.end_hld_mkt_val)) == (2000, 3600)
    assert (float(r.buy_amt), float(r.sal_amt), float(r.sprd_stock_estmt_amt)) == (1600, 600, 600)
    assert (float(r.tax_fee), float(r.cmsn), float(r.brkv_amt)) == (3, 4.4, 592.6)
    assert (r.acct_name, r.clsf_2, r.clsf_3) == ("first", "", "")
    assert (r.is_ods, r.is_top10_shdr, r.is_lift_ban_lmt_shdr) == ("1", "1", "0")


def test_accounts_without_master_leave_the_report(run, spark):
    inputs = run(hold_his=held(200, 300), sec_quot=QUOTES, tdsum_date_exchange=CALENDAR)
    assert final_report(inputs, flows_of(spark, 100), Decimal(0)).count() == 0
