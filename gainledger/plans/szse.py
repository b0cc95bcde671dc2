"""Flow rules of exchange 1. Each gives ledger rows: positive volumes, amounts and taxes.

Holding changes come in two generations of one source: integer codes until April 2017, text
codes and decimal volumes from May 2017. They are normalised to one set; a row outside the period
of its generation fails the query, so that no change counts twice and none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import negative_part, positive_part, security_code
from ..operators.checks import value_or_fail
from ..operators.temporal import OPEN_END, valid_on
from .flows import EXCHANGE_1, Inputs, ledger_rows, price_sums, totals, with_code
from .listing import allotments, last_day_before_listing, listing_events
from .sse import sum_outside_spells

# Codes and accounts that the rules read.
SETTLEMENT_ACCOUNT = "0899999004"
TRANSFER_CODES = ["A0A", "AOC", "A4A", "A69", "A72", "A76", "A77", "A89", "R04", "R05", "R06"]
ISSUE_CODE_OLD, ISSUE_CODE_NEW = "A30", "A44"
RIGHTS_CODE = "A42"
BONUS_CODES = ["A40", "A39"]
FUND_CODES = ["A88", "A91", "A92"]
UNLOCK_CODE = "A50"
INCENTIVE_NATURE = "02"
FREE_NATURE = "00"
CONVERSION_KINDS = ["30", "31", "32"]

FLOW_CODES = [
    *TRANSFER_CODES, ISSUE_CODE_OLD, ISSUE_CODE_NEW, RIGHTS_CODE, *BONUS_CODES, *FUND_CODES,
]

BUY_FEES = ["buy_hand_fee", "buy_stmp_tax", "buy_tran_fee", "buy_cmsn_chg"]
SELL_FEES = ["sal_hand_fee", "sal_stmp_tax", "sal_tran_fee", "sal_cmsn_chg"]


def trades(inputs: Inputs) -> DataFrame:
    """1000: ordinary trades, credit accounts included, lenders of the day left out."""
    scope = inputs.scope
    lines = (
        inputs.in_period("s_clr_trans_trad", "trad_date")
        .filter(F.col("shdr_acct") != SETTLEMENT_ACCOUNT)
        .withColumnRenamed("shdr_acct", "sec_acct")
    )
    lenders = (
        inputs.table("s_crdt_seat_acct_his")
        .select(F.col("sec_ln_broker_acct").alias("sec_acct"), "s_date", "e_date")
        .distinct()
    )
    fees = sum((F.coalesce(F.col(c), F.lit(0)) for c in BUY_FEES + SELL_FEES), F.lit(0))
    names = ["buy_vol", "sal_vol", "buy_amt", "sal_amt"]
    sums = [F.sum(n).alias(n) for n in [*names, "tax"]]
    lines = scope.deal(with_code(lines).select("sec_acct", "sec_cde", "trad_date", *names, fees.alias("tax")))
    flows = sum_outside_spells(inputs, lines, lenders, "trad_date", sums, [*names, "tax"])
    measures = {n: n for n in [*names, "tax"]}
    return ledger_rows(scope.keep(flows, EXCHANGE_1), EXCHANGE_1, "1000", scope.batch, **measures)


def holding_changes(inputs: Inputs, first: Column, last: Column) -> DataFrame:
    """Both generations of the changes from `first` to `last`; `is_new` tells them apart.

    The unit is the seat of an old row and the custody unit of a new one. The days reach the scan
    before the generation is checked.
    """
    cutover = F.lit(inputs.tables.cutover).cast("date")

    def one_form(name: str, unit: str, is_new: bool) -> DataFrame:
        day = F.col("chg_date")
        message = F.concat(F.lit(f"{name}: a change outside its generation, on "), day.cast("string"))
        own = (day >= cutover) if is_new else (day < cutover)
        return inputs.between(name, "chg_date", first, last).select(
            value_or_fail(own, day, message).alias("day"),
            F.col("shdr_acct").alias("sec_acct"),
            security_code(F.col("sec_cde")).alias("sec_cde"),
            F.col(unit).alias("unit"),
            "stk_chrc",
            "chg_cde",
            F.col("chg_vol").cast("decimal(20,2)").alias("chg_vol"),
            F.lit(is_new).alias("is_new"),
        )

    return one_form("s_shdr_hld_chg", "seat_cde", False).unionByName(one_form("s_stk_chg", "cstd_unit", True))


def daily_changes(inputs: Inputs) -> DataFrame:
    """Changes the flow rules read, as up and down volumes by account, security, day and kind.

    Every rule is linear in these two sums, so one stored copy serves all of them in a batch
    run. A rule that runs alone filters on the codes, and Catalyst carries the filter to the scan.
    """
    scope = inputs.scope
    changes = holding_changes(inputs, F.lit(scope.start), F.lit(scope.end))
    daily = (
        scope.deal(changes.filter(F.col("chg_cde").isin(FLOW_CODES)))
        .groupBy(
            "sec_acct", "sec_cde", "day", "chg_cde", "is_new",
            (F.col("stk_chrc") == INCENTIVE_NATURE).alias("is_incentive"),
        )
        .agg(
            F.sum(positive_part(F.col("chg_vol"))).alias("up"),
            F.sum(negative_part(F.col("chg_vol"))).alias("down"),
        )
    )
    return scope.keep(daily, EXCHANGE_1)


def _changes(inputs: Inputs, codes: list[str] | Column) -> DataFrame:
    wanted = F.col("chg_cde").isin(codes) if isinstance(codes, list) else codes
    return inputs.common("changes", lambda: daily_changes(inputs)).filter(wanted)


def transfers(inputs: Inputs) -> DataFrame:
    """2000: transfers outside trading; volumes only, amounts stay 0."""
    flows = totals(_changes(inputs, TRANSFER_CODES), buy_vol="up", sal_vol="down")
    return ledger_rows(
        flows, EXCHANGE_1, "2000", inputs.scope.batch, buy_vol="buy_vol", sal_vol="sal_vol"
    )


def ipo_events(inputs: Inputs) -> DataFrame:
    """Listings; every distinct (stock, listing date, price) counts."""
    issues = inputs.table("ipo_iss_info").select("stk_cde", "iss_prc", "list_date").distinct()
    return listing_events(inputs, EXCHANGE_1, last_day_before_listing(inputs, issues, "list_date"))


def ipo(inputs: Inputs) -> DataFrame:
    """3001: shares held on the last trading day before listing; amounts in whole units."""
    flows = allotments(inputs, EXCHANGE_1, ipo_events(inputs)).withColumn(
        "buy_amt", F.col("buy_amt").cast("decimal(18,0)")
    )
    return ledger_rows(
        flows, EXCHANGE_1, "3001", inputs.scope.batch, buy_vol="buy_vol", buy_amt="buy_amt"
    )


def _issue_lines(inputs: Inputs, incentive: bool) -> DataFrame:
    code = F.when(F.col("is_new"), ISSUE_CODE_NEW).otherwise(ISSUE_CODE_OLD)
    lines = _changes(inputs, F.col("chg_cde") == code)
    return lines.filter(
        (F.col("is_incentive") == F.lit(incentive)) & (F.col("sec_acct") != SETTLEMENT_ACCOUNT)
    ).withColumn("vol", F.col("up") - F.col("down"))


def _priced(inputs: Inputs, lines: DataFrame, prices: DataFrame, biz_type: str) -> DataFrame:
    """Ledger rows of lines whose (security, day) has price rows; see `price_sums`."""
    flows = totals(
        lines.join(prices, ["sec_cde", "day"]),
        buy_vol=F.col("vol") * F.col("n_prices"),
        buy_amt=F.col("vol") * F.col("sum_price"),
    )
    return ledger_rows(
        flows, EXCHANGE_1, biz_type, inputs.scope.batch, buy_vol="buy_vol", buy_amt="buy_amt"
    )


def listed_issues(inputs: Inputs) -> DataFrame:
    """The distinct (stock, listing date, price) of follow-on issues in the period.

    Several prices of one listing multiply its volumes; a batch run warns of them.
    """
    rows = inputs.table("szse_stk_fi_info").filter(inputs.scope.in_period("fi_list_date"))
    return rows.select("stk_cde", "fi_list_date", "iss_prc").distinct()


def follow_on(inputs: Inputs) -> DataFrame:
    """3002: follow-on issues at the issue price, booked the trading day before listing."""
    dated = last_day_before_listing(inputs, listed_issues(inputs), "fi_list_date")
    prices = price_sums(
        dated.select(F.col("stk_cde").alias("sec_cde"), F.col("ask_date").alias("day"), "iss_prc"),
        ["sec_cde", "day"],
        "iss_prc",
    )
    return _priced(inputs, _issue_lines(inputs, incentive=False), prices, "3002")


def incentive(inputs: Inputs) -> DataFrame:
    """3003: shares from equity incentive plans, at the close of the day."""
    lines = _issue_lines(inputs, incentive=True).join(inputs.close_on(EXCHANGE_1), ["sec_cde", "day"])
    flows = totals(lines, buy_vol="vol", buy_amt=F.col("vol") * F.col("cls_prc"))
    return ledger_rows(
        flows, EXCHANGE_1, "3003", inputs.scope.batch, buy_vol="buy_vol", buy_amt="buy_amt"
    )


def rights_issue(inputs: Inputs) -> DataFrame:
    """4002: subscribed rights at the subscription price of that stock and arrival day."""
    prices = (
        inputs.table("s_right_prmt_his")
        .filter((F.col("subsc_prc") != 0) & (F.col("e_date") == F.lit(OPEN_END)))
        .filter(inputs.scope.in_period("right_arrv_date"))
        .select(
            F.col("conv_sec_cde").alias("sec_cde"), F.col("right_arrv_date").alias("day"), "subsc_prc"
        )
    )
    lines = _changes(inputs, [RIGHTS_CODE]).withColumn("vol", F.col("up") - F.col("down"))
    return _priced(inputs, lines, price_sums(prices, ["sec_cde", "day"], "subsc_prc"), "4002")


def bonus(inputs: Inputs) -> DataFrame:
    """4001: bonus and capitalisation shares; volumes only."""
    flows = totals(_changes(inputs, BONUS_CODES), buy_vol=F.col("up") - F.col("down"))
    return ledger_rows(flows, EXCHANGE_1, "4001", inputs.scope.batch, buy_vol="buy_vol")


def dividend_rates(inputs: Inputs) -> DataFrame:
    """Cash rates of ordinary shares with their record dates, current versions."""
    rates = (
        inputs.table("s_divd_prmt_his")
        .filter((F.col("e_date") == F.lit(OPEN_END)) & (F.col("prcs_sts") == "Y"))
        .filter((F.col("equt_sort") == "HL") & (F.col("stk_chrc") == FREE_NATURE))
        .select("biz_nbr", "bef_tax_rate_numrt", "bef_tax_rate_denom")
    )
    dates = (
        inputs.table("s_equt_prmt_his")
        .filter((F.col("e_date") == F.lit(OPEN_END)) & inputs.scope.in_period("equity_reg_date"))
        .select("biz_nbr", "sec_cde", F.col("equity_reg_date").alias("ask_date"))
    )
    return inputs.scope.keep_securities(rates.join(dates, "biz_nbr").drop("biz_nbr"), EXCHANGE_1)


def dividend(inputs: Inputs) -> DataFrame:
    """4004: cash dividends, rate x shares held on the record date."""
    rates = dividend_rates(inputs)
    rows = inputs.held(EXCHANGE_1, rates).join(rates, ["sec_cde", "ask_date"])
    paid = F.col("hold_vol") * F.col("bef_tax_rate_numrt") / F.col("bef_tax_rate_denom")
    return ledger_rows(
        totals(rows, sal_amt=paid), EXCHANGE_1, "4004", inputs.scope.batch, sal_amt="sal_amt"
    )


def conversion(inputs: Inputs, prices: DataFrame | None = None) -> DataFrame:
    """5000: bonds turned into shares.

    Old source: at the conversion price in force on the processing day. New source: at `prices`
    (sec_cde, day, cls_prc), by default the close of the day, which stands in for that price.
    """
    scope = inputs.scope
    turned = (
        inputs.in_period("s_conv_bond_trad", "prcs_date")
        .filter(F.col("biz_sort").isin(CONVERSION_KINDS))
        .groupBy(F.col("shdr_acct").alias("sec_acct"), "conv_bond_cde", F.col("prcs_date").alias("day"))
        .agg(F.sum("conv_vol").alias("vol"))
    )
    terms = scope.keep_securities(
        with_code(inputs.table("s_conv_bond_reg")).select(
            F.col("conv_bond_cde").alias("bond"), "sec_cde", "conv_prc", "s_date", "e_date"
        ),
        EXCHANGE_1,
    )
    in_force = (F.col("conv_bond_cde") == F.col("bond")) & valid_on(F.col("day"))
    old = (
        scope.keep_accounts(turned)
        .join(terms, in_force)
        .select("sec_acct", "sec_cde", "vol", F.col("conv_prc").cast("decimal(18,3)").alias("price"))
    )
    settled = (
        inputs.in_period("s_dtl_result", "trad_date")
        .filter((F.col("biz_sort") == "ZQZG") & (F.col("setl_indc") == "Y") & (F.col("setl_vol") > 0))
        .groupBy(F.col("shdr_acct").alias("sec_acct"), "sec_cde", F.col("trad_date").alias("day"))
        .agg(F.sum("setl_vol").alias("vol"))
    )
    new = (
        scope.keep(settled, EXCHANGE_1)
        .join(inputs.close_on(EXCHANGE_1) if prices is None else prices, ["sec_cde", "day"])
        .select("sec_acct", "sec_cde", "vol", F.col("cls_prc").alias("price"))
    )
    flows = totals(old.unionByName(new), buy_vol="vol", buy_amt=F.col("vol") * F.col("price"))
    return ledger_rows(
        flows, EXCHANGE_1, "5000", scope.batch, buy_vol="buy_vol", buy_amt="buy_amt"
    )


def fund_units(inputs: Inputs) -> DataFrame:
    """6000: fund units created (up) and redeemed (down), at the close of the day."""
    lines = _changes(inputs, FUND_CODES).filter(F.col("sec_acct") != SETTLEMENT_ACCOUNT)
    flows = totals(
        lines.join(inputs.close_on(EXCHANGE_1), ["sec_cde", "day"]),
        buy_vol="up",
        sal_vol="down",
        buy_amt=F.col("up") * F.col("cls_prc"),
        sal_amt=F.col("down") * F.col("cls_prc"),
    )
    measures = {m: m for m in ("buy_vol", "sal_vol", "buy_amt", "sal_amt")}
    return ledger_rows(flows, EXCHANGE_1, "6000", inputs.scope.batch, **measures)


RULES = {
    "1000": trades,
    "2000": transfers,
    "3001": ipo,
    "3002": follow_on,
    "3003": incentive,
    "4002": rights_issue,
    "4001": bonus,
    "4004": dividend,
    "5000": conversion,
    "6000": fund_units,
}

# Rules' events whose holdings a batch run looks up in one pass.
HOLDING_EVENTS = [ipo_events, dividend_rates]
