"""Flow rules of exchange 0. Each gives ledger rows: positive volumes, amounts and taxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import security_code, sum_when
from ..operators.sizing import fits_broadcast
from ..operators.temporal import OPEN_END, without_covered
from .flows import EXCHANGE_0, Inputs, ledger_rows, totals, with_code
from .listing import allotments, last_day_before_listing, listing_events

# Accounts and text marks that the rules leave out.
SPECIAL_ACCOUNTS = ["B880810718", "B880859746", "B880969127", "B880969135"]
TRANSFER_OUT_ACCOUNTS = ["B880048866", "B882696518"]
TRANSFER_IN_ACCOUNT = "B880048866"
CONSIDERATION_REMARK = "对价"

# The clearing table carries the sign of the cash and share movement: bought shares and received
# cash are positive, sold shares, paid cash and all fees are negative.
CLEARING_IS_SIGNED = True

CLEARING_FEES = [
    "stmp_tax", "hand_fee", "tran_fee", "cmsn_chg", "admin_chrg", "oth_amt1", "oth_amt2", "oth_amt3",
]
CLEARING_SUMS = ["buy_vol", "sal_vol", "buy_amt", "sal_amt", "tax"]


def _clearing_sums() -> list:
    """Sums of one set of clearing lines, turned into positive magnitudes."""
    out = F.lit(-1 if CLEARING_IS_SIGNED else 1)
    bought, sold = F.col("trad_dirc") == "B", F.col("trad_dirc") == "S"
    return [
        sum_when(bought, F.col("setl_vol")).alias("buy_vol"),
        sum_when(sold, F.col("setl_vol") * out).alias("sal_vol"),
        sum_when(bought, F.col("clr_amt") * out).alias("buy_amt"),
        sum_when(sold, F.col("clr_amt")).alias("sal_amt"),
        sum_when(bought | sold, F.col("fees") * out).alias("tax"),
    ]


def _clearing_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """What the sums read of clearing lines, with six-character code and all fees in one."""
    fees = sum((F.col(c) for c in CLEARING_FEES[1:]), F.col(CLEARING_FEES[0]))
    code = security_code(F.col("sec_cde1")).alias("sec_cde")
    return lines.select(*keys, code, "trad_dirc", "setl_vol", "clr_amt", fees.alias("fees"))


def trades(inputs: Inputs) -> DataFrame:
    """1000: ordinary trades, without lines of margin-lending accounts on that day."""
    scope = inputs.scope
    lines = (
        inputs.in_period("clr_stm_dtl", "trad_date")
        .filter((F.col("biz_sort") == "001") & (F.col("sec_ctg") == "PT") & (F.col("trans_type") == "00A"))
        .filter((F.col("result_cde") == "0000") & (F.col("rcod_type") == "001"))
        .filter((F.col("setl_vol") != 0) & ~F.col("shdr_acct").isin(SPECIAL_ACCOUNTS))
        .withColumnRenamed("shdr_acct", "sec_acct")
    )
    lines = scope.deal(_clearing_lines(lines, "sec_acct", "trad_date"))
    lenders = (
        inputs.table("stm_acct_setup_his")
        .filter(F.col("acct_sort") == "RQ")
        .select(F.col("sec_setl_acct").alias("sec_acct"), "s_date", "e_date")
        .distinct()
    )
    flows = sum_outside_spells(inputs, lines, lenders, "trad_date", _clearing_sums(), CLEARING_SUMS)
    return _clearing_ledger(scope.keep(flows, EXCHANGE_0), "1000", scope.batch)


def sum_outside_spells(
    inputs: Inputs, lines: DataFrame, spells: DataFrame, day: str, sums: list, names: list[str]
) -> DataFrame:
    """Sums by account and security over the lines that no spell of the account covers.

    Few spells (counted): they are broadcast and the lines are filtered where they are read.
    Many: the lines are summed by day first, so that the shuffled anti join sees at most one
    row per account, security and day.
    """
    keys = ["sec_acct", "sec_cde"]
    spells = inputs.stored(spells, "spells")
    if fits_broadcast(spells):
        kept = without_covered(lines, F.broadcast(spells), "sec_acct", day)
        return kept.groupBy(*keys).agg(*sums)
    daily = lines.groupBy(*keys, day).agg(*sums)
    kept = without_covered(daily, spells, "sec_acct", day)
    return kept.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def _clearing_ledger(flows: DataFrame, biz_type: str, batch: str) -> DataFrame:
    measures = {name: name for name in CLEARING_SUMS}
    return ledger_rows(flows, EXCHANGE_0, biz_type, batch, **measures)


def margin_trades(inputs: Inputs) -> DataFrame:
    """1103: short sales, returns of bought shares and forced closes of credit accounts.

    Trades and clearing lines meet on day, application and trade number; the account is not
    compared, so every clearing line of such a number counts for the account of the trade.
    Both sides are summed before they meet: a number that repeats a million times on each side
    costs one row each, not a million squared. The orders are few against the clearing lines. They
    are stored and counted, and their numbers filter the lines, within the bound where these are
    read; beyond it the lines are dealt by number once, for the filter, their sums and the join.
    """
    scope = inputs.scope
    memo_1, memo_2 = F.substring("memo", 1, 1), F.substring("memo", 2, 1)
    is_sale = F.col("sal_shdr_acct").startswith("E") & (memo_2 == "6")
    is_return = F.col("b_shr_acct").startswith("E") & memo_1.isin("5", "7")
    sale = F.struct(F.col("sal_shdr_acct").alias("sec_acct"), F.col("sal_aply_nbr").alias("aply_nbr"))
    back = F.struct(F.col("b_shr_acct").alias("sec_acct"), F.col("buy_aply_nbr").alias("aply_nbr"))
    orders = (
        inputs.in_period("h_sec_trad", "trad_date")
        .filter(is_sale | is_return)
        .select(
            "trad_date", "trad_nbr", security_code(F.col("sec_cde")).alias("sec_cde"),
            F.explode(F.array_compact(F.array(F.when(is_sale, sale), F.when(is_return, back)))).alias("o"),
        )
        .select("trad_date", "trad_nbr", "sec_cde", "o.*")
        .groupBy("trad_date", "trad_nbr", "aply_nbr", "sec_acct", "sec_cde")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orders = (
        scope.keep(orders, EXCHANGE_0)
        .groupBy("trad_date", "trad_nbr", "aply_nbr", "sec_acct")
        .agg(F.sum("n").alias("n"))
    )
    orders = inputs.stored(orders, "margin_orders")
    number = ["trad_date", "trad_nbr", "aply_nbr"]
    lines = (
        inputs.in_period("clr_stm_dtl", "trad_date")
        .filter(F.col("result_cde").isin("0000", "8001") & F.col("rcod_type").isin("001", "003"))
    )
    numbers = orders.select(*number)
    numbers = F.broadcast(numbers) if fits_broadcast(orders) else numbers.hint("shuffle_hash")
    lines = _clearing_lines(lines, *number).join(numbers, number, "left_semi")
    cleared = lines.groupBy(*number, "sec_cde").agg(*_clearing_sums())
    matched = orders.join(scope.keep_securities(cleared, EXCHANGE_0), number)
    flows = totals(matched, **{c: F.col(c) * F.col("n") for c in CLEARING_SUMS})
    return _clearing_ledger(flows, "1103", scope.batch)


def transfers(inputs: Inputs) -> DataFrame:
    """2000: transfers outside trading, at the agreed price or, where it is 0, the close.

    Each row becomes an out leg and an in leg, summed by account, security and day in one pass;
    fees go to the out leg.
    """
    scope = inputs.scope
    fees = F.col("tran_fee") + F.col("stmp_tax") + F.col("cmsn_chg")
    out_leg = F.struct(F.col("ata").alias("sec_acct"), F.lit(True).alias("out"))
    in_leg = F.struct(F.col("in_acct").alias("sec_acct"), F.lit(False).alias("out"))
    own_price = F.col("tran_prc") != 0
    agreed = F.when(own_price, F.col("trans_vol") * F.col("tran_prc")).otherwise(F.lit(0))
    unpriced = F.when(own_price, F.lit(0)).otherwise(F.col("trans_vol"))
    legs = (
        inputs.in_period("h_non_trad_tran", "trans_date")
        .filter((F.col("cap_type") == "PT") & (F.col("succ_indc") == "0"))
        .filter(~F.col("aply_nbr").contains("WY") & ~F.col("ata").isin(TRANSFER_OUT_ACCOUNTS))
        .filter(F.col("in_acct") != TRANSFER_IN_ACCOUNT)
        .select(
            F.col("trans_date").alias("day"), security_code(F.col("sec_cde")).alias("sec_cde"),
            F.col("trans_vol").alias("vol"), agreed.alias("agreed"), unpriced.alias("unpriced"),
            fees.alias("fees"), F.explode(F.array(out_leg, in_leg)).alias("leg"),
        )
    )
    gone = F.col("leg.out")
    daily = scope.deal(legs).groupBy("leg.sec_acct", "sec_cde", "day").agg(
        *[
            sum_when(cond, F.col(c)).alias(f"{side}_{c}")
            for side, cond in (("out", gone), ("in", ~gone))
            for c in ("vol", "agreed", "unpriced")
        ],
        sum_when(gone, F.col("fees")).alias("tax"),
    )
    priced = scope.keep(daily, EXCHANGE_0).join(inputs.close_on(EXCHANGE_0), ["sec_cde", "day"])
    flows = totals(
        priced,
        buy_vol="in_vol",
        sal_vol="out_vol",
        buy_amt=F.col("in_agreed") + F.col("in_unpriced") * F.col("cls_prc"),
        sal_amt=F.col("out_agreed") + F.col("out_unpriced") * F.col("cls_prc"),
        tax="tax",
    )
    return _clearing_ledger(flows, "2000", scope.batch)


def ipo_events(inputs: Inputs) -> DataFrame:
    """Listings of exchange 0. One price of a stock counts once, at its latest day."""
    issues = (
        inputs.table("ipo_iss_info")
        .filter(F.col("sec_exch_cde") == EXCHANGE_0)
        .select("stk_cde", "iss_prc", "list_date")
    )
    # The latest listing decides the day, so it is chosen before the period is applied.
    latest = issues.groupBy("stk_cde", "iss_prc").agg(F.max("list_date").alias("list_date"))
    return listing_events(inputs, EXCHANGE_0, last_day_before_listing(inputs, latest, "list_date"))


def ipo(inputs: Inputs) -> DataFrame:
    """3001: shares held on the last trading day before listing, at the issue price."""
    flows = allotments(inputs, EXCHANGE_0, ipo_events(inputs))
    return ledger_rows(
        flows, EXCHANGE_0, "3001", inputs.scope.batch, buy_vol="buy_vol", buy_amt="buy_amt"
    )


def daily_transfer_lines(inputs: Inputs) -> DataFrame:
    """Transfer lines of the kinds several rules read, summed by account, code, day and kind.

    A rule that runs alone filters on the kind columns; Catalyst carries those filters below
    the sum to the scan. A batch run stores this set once and serves all rules from it.
    """
    kind = (
        ((F.col("cap_type") == "XL") & (F.col("trans_type") == "00F") & (F.col("trad_dirc") == "B"))
        | ((F.col("cap_type") == "PG") & (F.col("trans_type") == "00A") & (F.col("trad_dirc") == "B"))
        | ((F.col("cap_type") == "PT") & (F.col("trans_type") == "007"))
    )
    daily = (
        inputs.in_period("h_sec_tran", "trad_date")
        .filter(kind)
        .groupBy(
            F.col("shdr_acct").alias("sec_acct"), F.col("sec_cde").alias("raw_cde"),
            F.col("trad_date").alias("day"), "cap_type", "trans_type", "negt_type", "trad_dirc",
        )
        .agg(
            F.sum("trans_vol").alias("vol"),
            F.sum(F.col("trans_vol") * F.col("tran_prc")).alias("amt"),
            F.count_if(F.col("trans_vol") != 0).alias("n_moves"),
        )
    )
    return inputs.scope.keep_accounts(daily)


def _lines(inputs: Inputs, cap_type: str, trans_type: str, negt_type: str | None = None) -> DataFrame:
    lines = inputs.common("transfer_lines", lambda: daily_transfer_lines(inputs)).filter(
        (F.col("cap_type") == cap_type) & (F.col("trans_type") == trans_type)
    )
    if trans_type != "007":
        lines = lines.filter(F.col("trad_dirc") == "B")
    return lines if negt_type is None else lines.filter(F.col("negt_type") == negt_type)


def follow_on(inputs: Inputs) -> DataFrame:
    """3002: follow-on issues at the issue price of that stock and day."""
    scope = inputs.scope
    prices = (
        inputs.table("sse_stk_fi_info")
        .filter((F.col("e_date") == F.lit(OPEN_END)) & (F.col("stk_cde") != ""))
        .filter(scope.in_period("iss_date"))
        .groupBy(F.col("stk_cde").alias("sec_cde"), F.col("iss_date").alias("day"))
        .agg(F.max("iss_prc").alias("price"))
    )
    lines = scope.keep_securities(with_code(_lines(inputs, "XL", "00F", "F"), "raw_cde"), EXCHANGE_0)
    flows = totals(
        lines.join(prices, ["sec_cde", "day"]), buy_vol="vol", buy_amt=F.col("vol") * F.col("price")
    )
    return ledger_rows(flows, EXCHANGE_0, "3002", scope.batch, buy_vol="buy_vol", buy_amt="buy_amt")


def incentive(inputs: Inputs) -> DataFrame:
    """3003: shares from equity incentive plans, at the close of the day."""
    scope = inputs.scope
    lines = scope.keep_securities(with_code(_lines(inputs, "XL", "00F", "C"), "raw_cde"), EXCHANGE_0)
    flows = totals(
        lines.join(inputs.close_on(EXCHANGE_0), ["sec_cde", "day"]),
        buy_vol="vol",
        buy_amt=F.col("vol") * F.col("cls_prc"),
    )
    return ledger_rows(flows, EXCHANGE_0, "3003", scope.batch, buy_vol="buy_vol", buy_amt="buy_amt")


def rights_issue(inputs: Inputs) -> DataFrame:
    """4002: subscribed rights; the rights code leads to the stock for its year of entitlement."""
    scope = inputs.scope
    register = with_code(inputs.table("h_eqt_reg").filter(F.col("reg_sort") == "PG"))
    # One entitlement per record date; n_dates is how often a subscription of the year counts.
    stock_of = (
        register.select(
            F.col("iss_cde").alias("raw_cde"), "sec_cde",
            F.col("equt_years").cast("int").alias("year"), "reg_date",
        )
        .distinct()
        .groupBy("raw_cde", "sec_cde", "year")
        .agg(F.count(F.lit(1)).alias("n_dates"))
    )
    lines = (
        _lines(inputs, "PG", "00A")
        .filter(~F.col("sec_acct").isin(SPECIAL_ACCOUNTS))
        .withColumn("year", F.year("day"))
        .groupBy("sec_acct", "raw_cde", "year")
        .agg(F.sum("vol").alias("vol"), F.sum("amt").alias("amt"))
    )
    flows = totals(
        lines.join(scope.keep_securities(stock_of, EXCHANGE_0), ["raw_cde", "year"]),
        buy_vol=F.col("vol") * F.col("n_dates"),
        buy_amt=F.col("amt") * F.col("n_dates"),
    )
    return ledger_rows(flows, EXCHANGE_0, "4002", scope.batch, buy_vol="buy_vol", buy_amt="buy_amt")


def _register(inputs: Inputs) -> DataFrame:
    """Entitlements recorded in the period that are no share-reform consideration."""
    return with_code(
        inputs.table("h_eqt_reg")
        .filter(inputs.scope.in_period("reg_date"))
        .filter(~F.col("rmak_desc").contains(CONSIDERATION_REMARK))
        .withColumnRenamed("reg_date", "ask_date")
    )


def bonus_events(inputs: Inputs) -> DataFrame:
    rows = (
        _register(inputs)
        .filter(F.col("reg_sort") == "SG")
        .select("sec_cde", "ask_date", "allot_numrt", "allot_denom")
        .distinct()
    )
    return inputs.scope.keep_securities(rows, EXCHANGE_0)


def bonus(inputs: Inputs) -> DataFrame:
    """4001: bonus shares. The holding already contains them, hence n / (d + n) of it."""
    events = bonus_events(inputs)
    rows = inputs.held(EXCHANGE_0, events).join(events, ["sec_cde", "ask_date"])
    share = F.col("hold_vol") * F.col("allot_numrt") / (F.col("allot_denom") + F.col("allot_numrt"))
    flows = totals(rows, buy_vol=share)
    return ledger_rows(flows, EXCHANGE_0, "4001", inputs.scope.batch, buy_vol="buy_vol")


def dividend_events(inputs: Inputs) -> DataFrame:
    """Cash dividends with the bonus ratio of the same record date, if there is one."""
    cash = (
        _register(inputs)
        .filter((F.col("equt_type") == "HL") & (F.col("mkup_indc") == "1"))
        .select("sec_cde", "ask_date", "bef_tax_divd")
        .distinct()
    )
    ratio = F.col("allot_numrt") / F.col("allot_denom")
    rows = (
        cash.join(bonus_events(inputs), ["sec_cde", "ask_date"], "left")
        .groupBy("sec_cde", "ask_date", "bef_tax_divd", ratio.alias("ratio"))
        .agg(F.min(F.struct("allot_numrt", "allot_denom")).alias("b"))
        .select("sec_cde", "ask_date", "bef_tax_divd", "b.allot_numrt", "b.allot_denom")
    )
    return inputs.scope.keep_securities(rows, EXCHANGE_0)


def dividend(inputs: Inputs) -> DataFrame:
    """4004: cash dividends, per share = before-tax amount / 100, deflated by a bonus."""
    events = dividend_events(inputs)
    rows = inputs.held(EXCHANGE_0, events).join(events, ["sec_cde", "ask_date"])
    cash = F.col("hold_vol") * F.col("bef_tax_divd")
    denom, numrt = F.col("allot_denom"), F.col("allot_numrt")
    paid = F.when(numrt.isNull(), cash / 100).otherwise(cash * denom / (100 * (denom + numrt)))
    flows = totals(rows, sal_amt=paid)
    return ledger_rows(flows, EXCHANGE_0, "4004", inputs.scope.batch, sal_amt="sal_amt")


def conversion(inputs: Inputs) -> DataFrame:
    """5000: bonds turned into shares: the stock leg, once per bond leg with the same numbers."""
    scope = inputs.scope
    numbers = ["trad_date", "trad_nbr", "aply_nbr", "trad_time"]
    lines = (
        inputs.in_period("h_sec_tran", "trad_date")
        .filter(F.col("trans_type") == "00Y")
        .withColumnRenamed("shdr_acct", "sec_acct")
    )
    bond_legs = (
        lines.filter((F.col("cap_type") == "GZ") & (F.col("trad_dirc") == "S"))
        .groupBy("sec_acct", *numbers)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bond_legs = scope.keep_accounts(bond_legs).groupBy(*numbers).agg(F.sum("n").alias("n"))
    stock_legs = (
        with_code(lines.filter((F.col("cap_type") == "PT") & (F.col("trad_dirc") == "B")))
        .groupBy("sec_acct", "sec_cde", *numbers)
        .agg(F.sum("trans_vol").alias("vol"), F.sum(F.col("trans_vol") * F.col("tran_prc")).alias("amt"))
    )
    flows = totals(
        scope.keep(stock_legs, EXCHANGE_0).join(bond_legs, numbers),
        buy_vol=F.col("vol") * F.col("n"),
        buy_amt=F.col("amt") * F.col("n"),
    )
    return ledger_rows(flows, EXCHANGE_0, "5000", scope.batch, buy_vol="buy_vol", buy_amt="buy_amt")


def fund_units(inputs: Inputs) -> DataFrame:
    """6000: fund units created (buy) and redeemed (sell), at the close of the day."""
    scope = inputs.scope
    lines = with_code(
        _lines(inputs, "PT", "007").filter(
            (F.col("n_moves") > 0) & ~F.col("sec_acct").isin(SPECIAL_ACCOUNTS)
        ),
        "raw_cde",
    )
    priced = scope.keep_securities(lines, EXCHANGE_0).join(inputs.close_on(EXCHANGE_0), ["sec_cde", "day"])
    bought, sold = F.col("trad_dirc") == "B", F.col("trad_dirc") == "S"
    value = F.col("vol") * F.col("cls_prc")
    flows = priced.groupBy("sec_acct", "sec_cde").agg(
        sum_when(bought, F.col("vol")).alias("buy_vol"),
        sum_when(sold, F.col("vol")).alias("sal_vol"),
        sum_when(bought, value).alias("buy_amt"),
        sum_when(sold, value).alias("sal_amt"),
    )
    measures = {m: m for m in ("buy_vol", "sal_vol", "buy_amt", "sal_amt")}
    return ledger_rows(flows, EXCHANGE_0, "6000", scope.batch, **measures)


RULES = {
    "1000": trades,
    "1103": margin_trades,
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
HOLDING_EVENTS = [ipo_events, bonus_events, dividend_events]
