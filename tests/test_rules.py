"""Every flow rule on hand-made rows with numbers worked out by hand."""

from __future__ import annotations

import pytest
from conftest import measures

from gainledger.plans import sse, szse
from gainledger.plans.valuation import boundary_values, holding_gap, net_change

CLEARING = dict(
    shdr_acct="A1", rcod_type="001", trad_nbr=1, biz_sort="001", trans_type="00A", aply_nbr="1",
    trad_date="2016-05-03", sec_cde1=600000, sec_ctg="PT", trad_dirc="S", setl_vol=-100,
    clr_amt=1200, stmp_tax=-1, hand_fee=-1, tran_fee=-1, admin_chrg=0, cmsn_chg=0, oth_amt1=0,
    oth_amt2=0, oth_amt3=0, result_cde="0000",
)
HOLDING = dict(
    mkt_sort="0", sec_acct_nbr="A1", cstd_unit_id="U1", sec_cde="600000", cap_type="PT",
    td_end_hold_vol=1000, s_date="2016-01-01", e_date="3000-12-31",
)


def quote(day, price, code="600000", exch="0"):
    return dict(sec_exch_cde=exch, sec_cde=code, trad_date=day, cls_prc=price)


def test_sse_trade_signs_and_filters(run):
    lines = [
        CLEARING,
        CLEARING | dict(trad_dirc="B", setl_vol=40, clr_amt=-500, stmp_tax=0),
        CLEARING | dict(rcod_type="002"),
        CLEARING | dict(setl_vol=0),
        CLEARING | dict(result_cde="8001"),
        CLEARING | dict(shdr_acct="B880810718"),
        CLEARING | dict(shdr_acct="A2"),
        CLEARING | dict(sec_cde1=600001),
        CLEARING | dict(trad_date="2016-03-31"),
    ]
    inputs = run(accounts=("A1", "B880810718"), clr_stm_dtl=lines)
    assert measures(sse.trades(inputs)) == {("A1", "600000"): (40, 100, 500, 1200, 5)}


@pytest.mark.parametrize("small", [True, False])
def test_lenders_drop_out_only_while_valid(run, monkeypatch, small):
    monkeypatch.setattr(sse, "fits_broadcast", lambda df: small)
    lender = dict(acct_sort="RQ", sec_setl_acct="A1", s_date="2016-05-01", e_date="2016-09-01")
    lines = [
        CLEARING | dict(trad_date="2016-08-31"),
        CLEARING | dict(trad_date="2016-09-01", setl_vol=-7, clr_amt=70),
    ]
    others = [lender, lender | dict(acct_sort="PT", e_date="3000-12-31")]
    inputs = run(clr_stm_dtl=lines, stm_acct_setup_his=others)
    assert measures(sse.trades(inputs)) == {("A1", "600000"): (0, 7, 0, 70, 3)}


def test_sse_margin_counts_every_pair(run):
    trade = dict(
        trad_nbr=1, trad_date="2016-05-03", sec_cde=600000, b_shr_acct="E1", buy_aply_nbr="1",
        sal_shdr_acct="E2", sal_aply_nbr="9", memo="56",
    )
    lines = [CLEARING | dict(trad_dirc="B", setl_vol=10, clr_amt=-100), CLEARING]
    lines += [CLEARING | dict(aply_nbr="9", rcod_type="003", result_cde="8001", setl_vol=-3, clr_amt=30)]
    inputs = run(
        accounts=("E1", "E2"),
        h_sec_trad=[trade, trade, trade | dict(memo="11")],
        clr_stm_dtl=lines,
    )
    # Two equal trades meet both lines of application 1 (buyer) and the line of 9 (seller).
    assert measures(sse.margin_trades(inputs)) == {
        ("E1", "600000"): (20, 200, 200, 2400, 12),
        ("E2", "600000"): (0, 6, 0, 60, 6),
    }


TRANSFER = dict(
    trans_date="2016-05-03", aply_nbr="T1", ata="A1", in_acct="A2", sec_cde=600000, cap_type="PT",
    trans_vol=100, tran_prc=0, tran_fee=1, stmp_tax=2, cmsn_chg=3, succ_indc="0",
)


def test_sse_transfer_falls_back_to_close(run):
    rows = [TRANSFER, TRANSFER | dict(aply_nbr="XWY1"), TRANSFER | dict(succ_indc="1")]
    rows += [TRANSFER | dict(trans_date="2016-05-04")]  # no quote on that day
    inputs = run(accounts=("A1", "A2"), h_non_trad_tran=rows, sec_quot=[quote("2016-05-03", 12.5)])
    assert measures(sse.transfers(inputs)) == {
        ("A1", "600000"): (0, 100, 0, 1250, 6),
        ("A2", "600000"): (100, 0, 1250, 0, 0),
    }


def test_sse_transfer_both_legs_of_one_account(run):
    rows = [
        TRANSFER | dict(trans_vol=40, tran_prc=10),
        TRANSFER | dict(ata="A9", in_acct="A1", tran_prc=10),
    ]
    inputs = run(h_non_trad_tran=rows, sec_quot=[quote("2016-05-03", 12.5)])
    assert measures(sse.transfers(inputs)) == {("A1", "600000"): (100, 40, 1000, 400, 6)}


CALENDAR = [
    dict(calendar_date="2015-04-01", is_trd_dt="1"),
    dict(calendar_date="2016-04-28", is_trd_dt="1"),
    dict(calendar_date="2016-04-29", is_trd_dt="1"),
    dict(calendar_date="2016-04-30", is_trd_dt="0"),
    dict(calendar_date="2016-05-03", is_trd_dt="1"),
]


def test_sse_ipo_uses_last_open_day_before_listing(run):
    issue = dict(stk_cde="600000", list_date="2016-05-03", sec_exch_cde="0", iss_prc=8.5)
    held = [
        HOLDING | dict(s_date="2016-04-01", e_date="2016-04-29", td_end_hold_vol=5),
        HOLDING | dict(s_date="2016-04-29", td_end_hold_vol=600),
        HOLDING | dict(s_date="2016-04-29", td_end_hold_vol=400, cstd_unit_id="U2"),
    ]
    inputs = run(ipo_iss_info=[issue], tdsum_date_exchange=CALENDAR, hold_his=held)
    assert measures(sse.ipo(inputs)) == {("A1", "600000"): (1000, 0, 8500, 0, 0)}


def test_szse_ipo_rounds_amount_to_whole_units(run):
    issue = dict(stk_cde="000001", list_date="2016-05-03", sec_exch_cde="1", iss_prc=8.55)
    held = [HOLDING | dict(mkt_sort="1", sec_cde="000001", td_end_hold_vol=101)]
    inputs = run(ipo_iss_info=[issue], tdsum_date_exchange=CALENDAR, hold_his=held)
    assert measures(szse.ipo(inputs)) == {("A1", "000001"): (101, 0, 864, 0, 0)}


LINE = dict(
    trad_date="2016-05-03", trad_nbr=1, trad_dirc="B", shdr_acct="A1", sec_cde=600000,
    cap_type="XL", negt_type="F", equt_type="", trans_type="00F", trans_vol=100, tran_prc=9,
    trad_time=1, aply_nbr="1",
)


def test_sse_follow_on_takes_highest_current_price(run):
    price = dict(stk_cde="600000", iss_date="2016-05-03", iss_prc=5, e_date="3000-12-31")
    inputs = run(
        h_sec_tran=[LINE, LINE | dict(negt_type="C"), LINE | dict(trad_dirc="S")],
        sse_stk_fi_info=[price, price | dict(iss_prc=6), price | dict(iss_prc=7, e_date="2016-12-31")],
    )
    assert measures(sse.follow_on(inputs)) == {("A1", "600000"): (100, 0, 600, 0, 0)}


def test_sse_incentive_at_close(run):
    inputs = run(
        h_sec_tran=[LINE, LINE | dict(negt_type="C", trans_vol=30)],
        sec_quot=[quote("2016-05-03", 11)],
    )
    assert measures(sse.incentive(inputs)) == {("A1", "600000"): (30, 0, 330, 0, 0)}


def test_sse_rights_by_code_and_year(run):
    line = LINE | dict(cap_type="PG", trans_type="00A", sec_cde=700000, tran_prc=4)
    entry = dict(
        reg_sort="PG", sec_cde=600000, iss_cde=700000, equt_years=2016, reg_date="2016-04-20", rmak_desc=""
    )
    inputs = run(
        h_sec_tran=[line, line | dict(trad_date="2017-01-05")], h_eqt_reg=[entry, entry]
    )
    assert measures(sse.rights_issue(inputs)) == {("A1", "600000"): (100, 0, 400, 0, 0)}


BONUS = dict(
    reg_sort="SG", sec_cde=600000, iss_cde=600000, equt_type="SG", equt_years=2016,
    reg_date="2016-05-03", bef_tax_divd=0, allot_denom=10, allot_numrt=3, mkup_indc="0",
    rmak_desc="bonus",
)
CASH = BONUS | dict(reg_sort="HL", equt_type="HL", bef_tax_divd=500, mkup_indc="1")


def test_sse_bonus_share_of_holding(run):
    held = [HOLDING | dict(td_end_hold_vol=1300)]
    inputs = run(hold_his=held, h_eqt_reg=[BONUS, BONUS, BONUS | dict(rmak_desc="股改对价支付", allot_numrt=9)])
    assert measures(sse.bonus(inputs)) == {("A1", "600000"): (300, 0, 0, 0, 0)}


@pytest.mark.parametrize("register, amount", [([CASH], 6500), ([CASH, BONUS], 5000)])
def test_sse_dividend_with_and_without_bonus(run, register, amount):
    inputs = run(hold_his=[HOLDING | dict(td_end_hold_vol=1300)], h_eqt_reg=register)
    assert measures(sse.dividend(inputs)) == {("A1", "600000"): (0, 0, 0, amount, 0)}


def test_sse_dividend_equal_ratios_count_once(run):
    register = [CASH, BONUS, BONUS | dict(allot_denom=20, allot_numrt=6)]
    inputs = run(hold_his=[HOLDING | dict(td_end_hold_vol=1300)], h_eqt_reg=register)
    assert measures(sse.dividend(inputs)) == {("A1", "600000"): (0, 0, 0, 5000, 0)}


def test_sse_conversion_once_per_bond_leg(run):
    bond = LINE | dict(cap_type="GZ", trans_type="00Y", trad_dirc="S", sec_cde=110001)
    stock = LINE | dict(cap_type="PT", trans_type="00Y", trans_vol=50, tran_prc=8)
    inputs = run(h_sec_tran=[bond, bond, stock, stock | dict(trad_time=2)])
    assert measures(sse.conversion(inputs)) == {("A1", "600000"): (100, 0, 800, 0, 0)}


def test_sse_fund_units(run):
    line = LINE | dict(cap_type="PT", trans_type="007")
    rows = [line, line | dict(trad_dirc="S", trans_vol=30), line | dict(trans_vol=0)]
    inputs = run(h_sec_tran=rows, sec_quot=[quote("2016-05-03", 2)])
    assert measures(sse.fund_units(inputs)) == {("A1", "600000"): (100, 30, 200, 60, 0)}


def test_szse_trade_sums_columns_and_null_fees(run):
    row = dict(
        shdr_acct="A1", sec_cde=1, trad_date="2016-05-03", buy_vol=10, sal_vol=4, buy_amt=100,
        sal_amt=48, buy_hand_fee=1, sal_stmp_tax=2,
    )
    lender = dict(sec_ln_broker_acct="A1", s_date="2016-08-01", e_date="2016-09-01")
    rows = [row, row | dict(trad_date="2016-08-31"), row | dict(trad_date="2016-09-01", buy_vol=1)]
    inputs = run(s_clr_trans_trad=rows, s_crdt_seat_acct_his=[lender])
    assert measures(szse.trades(inputs)) == {("A1", "000001"): (11, 8, 200, 96, 6)}


OLD = dict(
    chg_date="2016-05-03", shdr_acct="A1", sec_cde=1, seat_cde="S", stk_chrc="00", chg_cde="A0A", chg_vol=70
)
NEW = dict(
    chg_date="2017-05-03", shdr_acct="A1", sec_cde="000001", cstd_unit="S", stk_chrc="00",
    chg_cde="A0A", chg_vol=-30,
)


def test_szse_transfer_both_generations(run):
    old = [OLD, OLD | dict(chg_cde="AOC", chg_vol=-1)]
    inputs = run(end="2018-04-01", s_shdr_hld_chg=old, s_stk_chg=[NEW])
    assert measures(szse.transfers(inputs)) == {("A1", "000001"): (70, 31, 0, 0, 0)}


@pytest.mark.parametrize(
    "rows",
    [
        dict(s_shdr_hld_chg=[OLD, OLD | dict(chg_date="2017-05-03")]),
        dict(s_stk_chg=[NEW, NEW | dict(chg_date="2016-05-03")]),
    ],
)
def test_change_outside_its_generation_fails(run, rows):
    with pytest.raises(Exception, match="outside its generation"):
        szse.transfers(run(end="2018-04-01", **rows)).collect()


def test_bond_conversion_at_given_prices(run, spark):
    settled = dict(shdr_acct="A1", biz_sort="ZQZG", sec_cde="000001", setl_vol=10, setl_indc="Y", trad_date="2016-05-03")
    inputs = run(s_dtl_result=[settled], sec_quot=[quote("2016-05-03", 12, "000001", "1")])
    assert measures(szse.conversion(inputs)) == {("A1", "000001"): (10, 0, 120, 0, 0)}
    given = spark.sql("SELECT '000001' AS sec_cde, DATE '2016-05-03' AS day, CAST(7 AS DECIMAL(18,3)) AS cls_prc")
    assert measures(szse.conversion(inputs, given)) == {("A1", "000001"): (10, 0, 70, 0, 0)}


def test_szse_follow_on_and_incentive(run):
    old = OLD | dict(chg_cde="A30", chg_date="2016-04-29", chg_vol=100)
    rows = [old, old | dict(stk_chrc="02", chg_vol=7), old | dict(chg_cde="A44")]
    issue = dict(stk_cde="000001", fi_list_date="2016-05-03", iss_prc=5)
    inputs = run(
        s_shdr_hld_chg=rows,
        szse_stk_fi_info=[issue, issue | dict(iss_prc=6)],
        tdsum_date_exchange=CALENDAR,
        sec_quot=[quote("2016-04-29", 9, "000001", "1")],
    )
    # Two issue prices of one listing double the volume, as two matching rows would.
    assert measures(szse.follow_on(inputs)) == {("A1", "000001"): (200, 0, 1100, 0, 0)}
    assert measures(szse.incentive(inputs)) == {("A1", "000001"): (7, 0, 63, 0, 0)}


def test_szse_rights_bonus_fund_units(run):
    rows = [
        OLD | dict(chg_cde="A42", chg_vol=10),
        OLD | dict(chg_cde="A40", chg_vol=20),
        OLD | dict(chg_cde="A39", chg_vol=-5),
        OLD | dict(chg_cde="A88", chg_vol=8),
        OLD | dict(chg_cde="A92", chg_vol=-3),
    ]
    price = dict(subsc_prc=4, conv_sec_cde="000001", right_arrv_date="2016-05-03", e_date="3000-12-31")
    inputs = run(
        s_shdr_hld_chg=rows,
        s_right_prmt_his=[price, price | dict(subsc_prc=0), price | dict(e_date="2016-12-31")],
        sec_quot=[quote("2016-05-03", 2, "000001", "1")],
    )
    assert measures(szse.rights_issue(inputs)) == {("A1", "000001"): (10, 0, 40, 0, 0)}
    assert measures(szse.bonus(inputs)) == {("A1", "000001"): (15, 0, 0, 0, 0)}
    assert measures(szse.fund_units(inputs)) == {("A1", "000001"): (8, 3, 16, 6, 0)}


def test_szse_dividend(run):
    rate = dict(
        biz_nbr="D", equt_sort="HL", stk_chrc="00", bef_tax_rate_numrt=5, bef_tax_rate_denom=10,
        prcs_sts="Y", e_date="3000-12-31",
    )
    dates = dict(sec_cde="000001", biz_nbr="D", equity_reg_date="2016-05-03", e_date="3000-12-31")
    inputs = run(
        s_divd_prmt_his=[rate, rate | dict(prcs_sts="N"), rate | dict(stk_chrc="01")],
        s_equt_prmt_his=[dates],
        hold_his=[HOLDING | dict(mkt_sort="1", sec_cde="000001")],
    )
    assert measures(szse.dividend(inputs)) == {("A1", "000001"): (0, 0, 0, 500, 0)}


def test_szse_conversion_price_versions(run):
    turned = dict(conv_bond_cde=125, shdr_acct="A1", prcs_date="2016-05-03", conv_vol=10, biz_sort="30")
    terms = dict(conv_bond_cde=125, sec_cde=1, conv_prc=7, s_date="2016-01-01", e_date="2016-05-03")
    settled = dict(
        shdr_acct="A1", biz_sort="ZQZG", sec_cde="000001", setl_vol=4, setl_indc="Y", trad_date="2016-05-03"
    )
    inputs = run(
        s_conv_bond_trad=[turned, turned | dict(biz_sort="39")],
        s_conv_bond_reg=[terms, terms | dict(conv_prc=8, s_date="2016-05-03", e_date="3000-12-31")],
        s_dtl_result=[settled, settled | dict(setl_vol=-4), settled | dict(setl_indc="N")],
        sec_quot=[quote("2016-05-03", 2, "000001", "1")],
    )
    assert measures(szse.conversion(inputs)) == {("A1", "000001"): (14, 0, 88, 0, 0)}


# --- reconciliation -------------------------------------------------------------------------

LEDGER = "exch string, sec_acct string, sec_cde string, biz_type string, tax_fee decimal(18,3), " \
    "buy_vol decimal(18,0), sal_vol decimal(18,0), buy_amt decimal(18,2), sal_amt decimal(18,2), batch string"


def flows_of(spark, bought, sold=0, biz="1000"):
    from decimal import Decimal as D

    row = ("0", "A1", "600000", biz, D(0), D(bought), D(sold), D(0), D(0), "b1")
    return spark.createDataFrame([row], LEDGER)


QUOTES = [quote("2016-04-05", 10), quote("2017-03-30", 12), quote("2016-09-01", 50)]


def held(start, end):
    rows = []
    if start is not None:
        rows.append(HOLDING | dict(td_end_hold_vol=start, e_date="2016-12-01"))
    if end is not None:
        rows.append(HOLDING | dict(td_end_hold_vol=end, s_date="2016-12-01"))
    return rows


@pytest.mark.parametrize(
    "start, end, recorded, expected",
    [
        (100, 250, 100, (50, 0, 600, 0, 0)),  # more shares than explained, at the closing price
        (100, 100, 50, (0, 50, 0, 500, 0)),  # fewer shares, at the opening price
        (None, 80, 80, None),  # explained
        (60, None, 0, (0, 60, 0, 600, 0)),  # no holding row at the end
        (None, None, 100, None),  # no holding row at either end
    ],
)
def test_gap(run, spark, start, end, recorded, expected):
    inputs = run(hold_his=held(start, end), sec_quot=QUOTES)
    rows = measures(holding_gap(inputs, flows_of(spark, recorded), "0"))
    assert rows == ({} if expected is None else {("A1", "600000"): expected})


def test_gap_needs_a_flow(run, spark):
    inputs = run(hold_his=held(100, 250), sec_quot=QUOTES)
    assert measures(holding_gap(inputs, flows_of(spark, 0).limit(0), "0")) == {}


def test_net_change_ignores_gap_rows(spark):
    ledger = flows_of(spark, 100, 30).unionByName(flows_of(spark, 7, 0, "9999"))
    assert [int(r.chg_vol) for r in net_change(ledger).collect()] == [70]


def test_boundary_values(run):
    inputs = run(hold_his=held(200, 300), sec_quot=QUOTES)
    [row] = boundary_values(inputs).collect()
    assert (float(row.start_bal), float(row.end_bal)) == (2000, 3600)
