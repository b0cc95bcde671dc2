"""The same queries as plain SQL, for checking against another engine.

Every relation is written row by row from the meaning of the rule: no sums before joins, no
shared sets, exact integer arithmetic where a division is rounded. `{name}` refers to another
relation, to a source view or to a given table.
"""

from __future__ import annotations

from .queries import BATCH, CLASSES, END, RATE, START
from .sources.star_tables import CUTOVER, VIEWS, _code, references

S = f"DATE '{START}'"
E = f"DATE '{END}'"
OPEN = "DATE '3000-12-31'"
CLASS_LIST = ", ".join(f"'{c}'" for c in CLASSES)
SPECIAL = "('B880810718', 'B880859746', 'B880969127', 'B880969135')"


def _in(account: str | None = None, code: str | None = None, exch: str = "0") -> str:
    """Membership of the run's accounts and instruments."""
    tests = []
    if account:
        tests.append(f"{account} IN (SELECT sec_acct FROM {{accts}})")
    if code:
        tests.append(f"{code} IN (SELECT sec_cde FROM {{secs}} WHERE exch = '{exch}')")
    return " AND ".join(tests)


def _period(day: str) -> str:
    return f"{day} BETWEEN {S} AND {E}"


def _half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero, without floating point."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def _ledger(
    exch: str, biz: str, source: str, *, acct: str = "sec_acct", code: str = "sec_cde",
    tax: str = "0", buy_vol: str = "0", sal_vol: str = "0", buy_amt: str = "0", sal_amt: str = "0",
) -> str:
    def total(value: str, kind: str) -> str:
        return f"CAST(coalesce(sum({value}), 0) AS {kind})"

    return f"""
      SELECT '{exch}' AS exch, {acct} AS sec_acct, {code} AS sec_cde, '{biz}' AS biz_type,
             {total(tax, 'DECIMAL(18,3)')} AS tax_fee, {total(buy_vol, 'DECIMAL(18,0)')} AS buy_vol,
             {total(sal_vol, 'DECIMAL(18,0)')} AS sal_vol,
             {total(buy_amt, 'DECIMAL(18,2)')} AS buy_amt,
             {total(sal_amt, 'DECIMAL(18,2)')} AS sal_amt, '{BATCH}' AS batch
      FROM {source} GROUP BY {acct}, {code}"""


_FEES = (
    "(c.stmp_tax + c.hand_fee + c.tran_fee + c.cmsn_chg + c.admin_chrg"
    " + c.oth_amt1 + c.oth_amt2 + c.oth_amt3)"
)
_CLEARING = dict(
    tax=f"CASE WHEN c.trad_dirc IN ('B', 'S') THEN -{_FEES} ELSE 0 END",
    buy_vol="CASE WHEN c.trad_dirc = 'B' THEN c.setl_vol ELSE 0 END",
    sal_vol="CASE WHEN c.trad_dirc = 'S' THEN -c.setl_vol ELSE 0 END",
    buy_amt="CASE WHEN c.trad_dirc = 'B' THEN -c.clr_amt ELSE 0 END",
    sal_amt="CASE WHEN c.trad_dirc = 'S' THEN c.clr_amt ELSE 0 END",
)
_HELD = """{hold_his} h JOIN %s v ON h.sec_cde = v.sec_cde AND h.s_date <= v.day
      AND h.e_date > v.day AND h.mkt_sort = '%s'"""
_PREVIOUS_DAY = """(SELECT max(calendar_date) FROM {tdsum_date_exchange}
      WHERE is_trd_dt = '1' AND calendar_date < %s)"""

RELATIONS: dict[str, str] = {
    "accts": f"SELECT DISTINCT sec_acct FROM {{intg_sec_acct}} WHERE e_date > {S}",
    "codes": f"""SELECT DISTINCT sec_cde FROM {{sec_info}}
      WHERE sec_ctg = '11' AND mkt_sort IN ('0', '1') AND e_date > {S}""",
    "secs": f"""SELECT DISTINCT mkt_sort AS exch, sec_cde FROM {{sec_info}}
      WHERE e_date > {S} AND sec_cde IN (SELECT sec_cde FROM {{codes}})""",
    "closes": "SELECT sec_exch_cde AS exch, sec_cde, trad_date AS day, cls_prc FROM {sec_quot}",
    # --- exchange 0 ----------------------------------------------------------------------
    "sse_trade": _ledger(
        "0", "1000",
        f"""(SELECT t.*, {_code('t.sec_cde1')} AS code FROM {{clr_stm_dtl}} t
          WHERE {_period('t.trad_date')} AND t.biz_sort = '001' AND t.sec_ctg = 'PT'
            AND t.trans_type = '00A' AND t.result_cde = '0000' AND t.rcod_type = '001'
            AND t.setl_vol <> 0 AND t.shdr_acct NOT IN {SPECIAL}
            AND NOT EXISTS (SELECT 1 FROM {{stm_acct_setup_his}} l WHERE l.acct_sort = 'RQ'
              AND l.sec_setl_acct = t.shdr_acct AND l.s_date <= t.trad_date
              AND l.e_date > t.trad_date)) c
        WHERE {_in('c.shdr_acct', 'c.code')}""",
        acct="c.shdr_acct", code="c.code", **_CLEARING,
    ),
    "margin_order": f"""
      SELECT trad_date, trad_nbr, sal_shdr_acct AS acct, sal_aply_nbr AS aply_nbr,
             {_code('sec_cde')} AS code
      FROM {{h_sec_trad}} WHERE sal_shdr_acct LIKE 'E%' AND substr(memo, 2, 1) = '6'
      UNION ALL
      SELECT trad_date, trad_nbr, b_shr_acct, buy_aply_nbr, {_code('sec_cde')}
      FROM {{h_sec_trad}} WHERE b_shr_acct LIKE 'E%' AND substr(memo, 1, 1) IN ('5', '7')""",
    "sse_margin": _ledger(
        "0", "1103",
        f"""(SELECT o.acct, {_code('t.sec_cde1')} AS cleared_code, t.*
          FROM {{margin_order}} o JOIN {{clr_stm_dtl}} t ON o.trad_date = t.trad_date
            AND o.aply_nbr = t.aply_nbr AND o.trad_nbr = t.trad_nbr
          WHERE {_period('o.trad_date')} AND {_in('o.acct', 'o.code')}
            AND t.result_cde IN ('0000', '8001') AND t.rcod_type IN ('001', '003')) c
        WHERE {_in(None, 'c.cleared_code')}""",
        acct="c.acct", code="c.cleared_code", **_CLEARING,
    ),
    "transfer_line": f"""
      SELECT t.*, {_code('t.sec_cde')} AS code,
             CASE WHEN t.tran_prc <> 0 THEN t.tran_prc
                  ELSE CAST(q.cls_prc AS DECIMAL(18,6)) END AS price
      FROM {{h_non_trad_tran}} t
      JOIN {{closes}} q ON q.exch = '0' AND q.day = t.trans_date AND q.sec_cde = {_code('t.sec_cde')}
      WHERE {_period('t.trans_date')} AND t.cap_type = 'PT' AND t.succ_indc = '0'
        AND t.aply_nbr NOT LIKE '%WY%' AND t.ata NOT IN ('B880048866', 'B882696518')
        AND t.in_acct <> 'B880048866' AND {_in(None, _code('t.sec_cde'))}""",
    "transfer_out": f"""SELECT ata AS acct, code, trans_date, sum(trans_vol) AS vol,
      sum(trans_vol * price) AS amt, sum(tran_fee + stmp_tax + cmsn_chg) AS tax
      FROM {{transfer_line}} WHERE {_in('ata')} GROUP BY ata, code, trans_date""",
    "transfer_in": f"""SELECT in_acct AS acct, code, trans_date, sum(trans_vol) AS vol,
      sum(trans_vol * price) AS amt
      FROM {{transfer_line}} WHERE {_in('in_acct')} GROUP BY in_acct, code, trans_date""",
    "sse_transfer": _ledger(
        "0", "2000",
        """(SELECT coalesce(o.acct, i.acct) AS sec_acct, coalesce(o.code, i.code) AS sec_cde,
            o.vol AS out_vol, o.amt AS out_amt, o.tax, i.vol AS in_vol, i.amt AS in_amt
          FROM {transfer_out} o FULL JOIN {transfer_in} i
            ON o.acct = i.acct AND o.code = i.code AND o.trans_date = i.trans_date) f""",
        tax="tax", buy_vol="in_vol", sal_vol="out_vol", buy_amt="in_amt", sal_amt="out_amt",
    ),
    "sse_ipo": _ledger(
        "0", "3001",
        _HELD % (f"""(SELECT stk_cde AS sec_cde, CAST(iss_prc AS DECIMAL(18,6)) AS iss_prc,
          max({_PREVIOUS_DAY % 'list_date'}) AS day FROM {{ipo_iss_info}} WHERE sec_exch_cde = '0'
          GROUP BY stk_cde, iss_prc)""", "0")
        + f" WHERE {_period('v.day')} AND {_in('h.sec_acct_nbr', 'h.sec_cde')}",
        acct="h.sec_acct_nbr", code="h.sec_cde", buy_vol="h.td_end_hold_vol",
        buy_amt="h.td_end_hold_vol * v.iss_prc",
    ),
    "sse_followon": _ledger(
        "0", "3002",
        f"""(SELECT t.shdr_acct AS sec_acct, {_code('t.sec_cde')} AS sec_cde, t.trans_vol, p.prc
          FROM {{h_sec_tran}} t JOIN (SELECT stk_cde, iss_date, max(iss_prc) AS prc
            FROM {{sse_stk_fi_info}} WHERE e_date = {OPEN} AND stk_cde <> ''
            GROUP BY stk_cde, iss_date) p
          ON p.stk_cde = {_code('t.sec_cde')} AND p.iss_date = t.trad_date
          WHERE t.cap_type = 'XL' AND t.negt_type = 'F' AND t.trans_type = '00F'
            AND t.trad_dirc = 'B' AND {_period('t.trad_date')}) f
        WHERE {_in('sec_acct', 'sec_cde')}""",
        buy_vol="trans_vol", buy_amt="trans_vol * prc",
    ),
    "sse_incentive": _ledger(
        "0", "3003",
        f"""(SELECT t.shdr_acct AS sec_acct, q.sec_cde, t.trans_vol, q.cls_prc
          FROM {{h_sec_tran}} t JOIN {{closes}} q ON q.exch = '0' AND q.day = t.trad_date
            AND q.sec_cde = {_code('t.sec_cde')}
          WHERE t.cap_type = 'XL' AND t.negt_type = 'C' AND t.trans_type = '00F'
            AND t.trad_dirc = 'B' AND {_period('t.trad_date')}) f
        WHERE {_in('sec_acct', 'sec_cde')}""",
        buy_vol="trans_vol", buy_amt="trans_vol * cls_prc",
    ),
    "sse_rights": _ledger(
        "0", "4002",
        f"""(SELECT t.shdr_acct AS sec_acct, r.sec_cde, t.trans_vol, t.tran_prc
          FROM {{h_sec_tran}} t JOIN (SELECT DISTINCT iss_cde, {_code('sec_cde')} AS sec_cde,
              equt_years, reg_date FROM {{h_eqt_reg}} WHERE reg_sort = 'PG') r
            ON r.iss_cde = t.sec_cde AND r.equt_years = year(t.trad_date)
          WHERE t.trans_type = '00A' AND t.trad_dirc = 'B' AND t.cap_type = 'PG'
            AND t.shdr_acct NOT IN {SPECIAL} AND {_period('t.trad_date')}) f
        WHERE {_in('sec_acct', 'sec_cde')}""",
        buy_vol="trans_vol", buy_amt="trans_vol * tran_prc",
    ),
    "sse_bonus_event": f"""SELECT DISTINCT {_code('sec_cde')} AS sec_cde, reg_date AS day,
      allot_numrt AS n, allot_denom AS d FROM {{h_eqt_reg}}
      WHERE reg_sort = 'SG' AND rmak_desc NOT LIKE '%对价%' AND {_period('reg_date')}""",
    "sse_bonus": _ledger(
        "0", "4001",
        "(SELECT h.sec_acct_nbr AS sec_acct, h.sec_cde, v.n, v.d, sum(h.td_end_hold_vol) AS vol FROM "
        + _HELD % ("{sse_bonus_event}", "0")
        + f" WHERE {_in('h.sec_acct_nbr', 'h.sec_cde')}"
        + " GROUP BY h.sec_acct_nbr, h.sec_cde, v.day, v.n, v.d) f",
        buy_vol=_half_up("vol * n", "d + n"),
    ),
    "sse_cash_event": f"""SELECT DISTINCT c.sec_cde, c.day, c.divd, b.n, b.d
      FROM (SELECT {_code('sec_cde')} AS sec_cde, reg_date AS day, bef_tax_divd AS divd
            FROM {{h_eqt_reg}} WHERE equt_type = 'HL' AND mkup_indc = '1'
              AND rmak_desc NOT LIKE '%对价%' AND {_period('reg_date')}) c
      LEFT JOIN {{sse_bonus_event}} b ON b.sec_cde = c.sec_cde AND b.day = c.day""",
    "sse_dividend": _ledger(
        "0", "4004",
        "(SELECT h.sec_acct_nbr AS sec_acct, h.sec_cde, v.divd, coalesce(v.n, 0) AS n,"
        " coalesce(v.d, 1) AS d, sum(h.td_end_hold_vol) AS vol FROM "
        + _HELD % ("{sse_cash_event}", "0")
        + f" WHERE {_in('h.sec_acct_nbr', 'h.sec_cde')}"
        + " GROUP BY h.sec_acct_nbr, h.sec_cde, v.day, v.divd, v.n, v.d) f",
        sal_amt=f"CAST({_half_up('CAST(vol AS HUGEINT) * CAST(divd AS HUGEINT) * CAST(d AS HUGEINT)', 'd + n')} AS DECIMAL(20,0)) * 0.01",
    ),
    "sse_conversion": _ledger(
        "0", "5000",
        f"""(SELECT s.shdr_acct AS sec_acct, {_code('s.sec_cde')} AS sec_cde, s.trans_vol, s.tran_prc
          FROM {{h_sec_tran}} b JOIN {{h_sec_tran}} s ON b.trad_date = s.trad_date
            AND b.trad_nbr = s.trad_nbr AND b.aply_nbr = s.aply_nbr AND b.trad_time = s.trad_time
          WHERE b.trans_type = '00Y' AND b.cap_type = 'GZ' AND b.trad_dirc = 'S'
            AND s.trans_type = '00Y' AND s.cap_type = 'PT' AND s.trad_dirc = 'B'
            AND {_period('s.trad_date')} AND {_in('b.shdr_acct')}) f
        WHERE {_in('sec_acct', 'sec_cde')}""",
        buy_vol="trans_vol", buy_amt="trans_vol * tran_prc",
    ),
    "sse_etf": _ledger(
        "0", "6000",
        f"""(SELECT t.shdr_acct AS sec_acct, q.sec_cde, t.trad_dirc, t.trans_vol, q.cls_prc
          FROM {{h_sec_tran}} t JOIN {{closes}} q ON q.exch = '0' AND q.day = t.trad_date
            AND q.sec_cde = {_code('t.sec_cde')}
          WHERE t.cap_type = 'PT' AND t.trans_type = '007' AND t.trans_vol <> 0
            AND t.shdr_acct NOT IN {SPECIAL} AND {_period('t.trad_date')}) f
        WHERE {_in('sec_acct', 'sec_cde')}""",
        buy_vol="CASE WHEN trad_dirc = 'B' THEN trans_vol ELSE 0 END",
        sal_vol="CASE WHEN trad_dirc = 'S' THEN trans_vol ELSE 0 END",
        buy_amt="CASE WHEN trad_dirc = 'B' THEN trans_vol * cls_prc ELSE 0 END",
        sal_amt="CASE WHEN trad_dirc = 'S' THEN trans_vol * cls_prc ELSE 0 END",
    ),
    # --- exchange 1 ----------------------------------------------------------------------
    "szse_trade": _ledger(
        "1", "1000",
        f"""(SELECT t.*, t.shdr_acct AS sec_acct, {_code('t.sec_cde')} AS code
          FROM {{s_clr_trans_trad}} t
          WHERE {_period('t.trad_date')} AND t.shdr_acct <> '0899999004'
            AND NOT EXISTS (SELECT 1 FROM {{s_crdt_seat_acct_his}} l
              WHERE l.sec_ln_broker_acct = t.shdr_acct AND l.s_date <= t.trad_date
                AND l.e_date > t.trad_date)) f
        WHERE {_in('sec_acct', 'code', '1')}""",
        code="code", buy_vol="buy_vol", sal_vol="sal_vol", buy_amt="buy_amt", sal_amt="sal_amt",
        tax="coalesce(buy_hand_fee, 0) + coalesce(buy_stmp_tax, 0) + coalesce(buy_tran_fee, 0)"
        " + coalesce(buy_cmsn_chg, 0) + coalesce(sal_hand_fee, 0) + coalesce(sal_stmp_tax, 0)"
        " + coalesce(sal_tran_fee, 0) + coalesce(sal_cmsn_chg, 0)",
    ),
    "change": f"""
      SELECT chg_date AS day, shdr_acct AS sec_acct, {_code('sec_cde')} AS sec_cde,
             seat_cde AS unit, stk_chrc, chg_cde, CAST(chg_vol AS DECIMAL(20,2)) AS vol, 'old' AS gen
      FROM {{s_shdr_hld_chg}} WHERE chg_date < DATE '{CUTOVER}'
      UNION ALL
      SELECT chg_date, shdr_acct, {_code('sec_cde')}, cstd_unit, stk_chrc, chg_cde, chg_vol, 'new'
      FROM {{s_stk_chg}} WHERE chg_date >= DATE '{CUTOVER}'""",
    "run_change": f"""SELECT * FROM {{change}}
      WHERE {_period('day')} AND {_in('sec_acct', 'sec_cde', '1')}""",
    "szse_transfer": _ledger(
        "1", "2000",
        """{run_change} WHERE chg_cde IN ('A0A', 'AOC', 'A4A', 'A69', 'A72', 'A76', 'A77', 'A89',
          'R04', 'R05', 'R06')""",
        buy_vol="CASE WHEN vol > 0 THEN vol ELSE 0 END",
        sal_vol="CASE WHEN vol < 0 THEN abs(vol) ELSE 0 END",
    ),
    "szse_ipo": _ledger(
        "1", "3001",
        _HELD % (f"""(SELECT DISTINCT stk_cde AS sec_cde, CAST(iss_prc AS DECIMAL(18,6)) AS iss_prc,
          list_date, {_PREVIOUS_DAY % 'list_date'} AS day FROM {{ipo_iss_info}})""", "1")
        + f" WHERE {_period('v.day')} AND {_in('h.sec_acct_nbr', 'h.sec_cde', '1')}",
        acct="h.sec_acct_nbr", code="h.sec_cde", buy_vol="h.td_end_hold_vol",
        buy_amt="h.td_end_hold_vol * v.iss_prc",
    ).replace(
        "CAST(coalesce(sum(h.td_end_hold_vol * v.iss_prc), 0) AS DECIMAL(18,2))",
        "CAST(CAST(coalesce(sum(h.td_end_hold_vol * v.iss_prc), 0) AS DECIMAL(18,0)) AS DECIMAL(18,2))",
    ),
    "issue_line": """SELECT * FROM {run_change} WHERE sec_acct <> '0899999004'
      AND ((gen = 'old' AND chg_cde = 'A30') OR (gen = 'new' AND chg_cde = 'A44'))""",
    "szse_followon": _ledger(
        "1", "3002",
        f"""(SELECT c.sec_acct, c.sec_cde, c.vol, p.iss_prc FROM {{issue_line}} c
          JOIN (SELECT DISTINCT stk_cde, fi_list_date, iss_prc,
                  {_PREVIOUS_DAY % 'fi_list_date'} AS day FROM {{szse_stk_fi_info}}
                WHERE {_period('fi_list_date')}) p ON p.stk_cde = c.sec_cde AND p.day = c.day
          WHERE c.stk_chrc <> '02') f""",
        buy_vol="vol", buy_amt="vol * iss_prc",
    ),
    "szse_incentive": _ledger(
        "1", "3003",
        """(SELECT c.sec_acct, c.sec_cde, c.vol, q.cls_prc FROM {issue_line} c
          JOIN {closes} q ON q.exch = '1' AND q.sec_cde = c.sec_cde AND q.day = c.day
          WHERE c.stk_chrc = '02') f""",
        buy_vol="vol", buy_amt="vol * cls_prc",
    ),
    "szse_rights": _ledger(
        "1", "4002",
        f"""(SELECT c.sec_acct, c.sec_cde, c.vol, p.subsc_prc FROM {{run_change}} c
          JOIN {{s_right_prmt_his}} p ON p.conv_sec_cde = c.sec_cde AND p.right_arrv_date = c.day
          WHERE c.chg_cde = 'A42' AND p.subsc_prc <> 0 AND p.e_date = {OPEN}) f""",
        buy_vol="vol", buy_amt="vol * subsc_prc",
    ),
    "szse_bonus": _ledger("1", "4001", "{run_change} WHERE chg_cde IN ('A40', 'A39')", buy_vol="vol"),
    "szse_cash_event": f"""SELECT d.sec_cde, d.equity_reg_date AS day,
        r.bef_tax_rate_numrt AS n, r.bef_tax_rate_denom AS d
      FROM {{s_divd_prmt_his}} r JOIN {{s_equt_prmt_his}} d ON r.biz_nbr = d.biz_nbr
      WHERE r.e_date = {OPEN} AND d.e_date = {OPEN} AND r.prcs_sts = 'Y' AND r.equt_sort = 'HL'
        AND r.stk_chrc = '00' AND {_period('d.equity_reg_date')}""",
    "szse_dividend": _ledger(
        "1", "4004",
        "(SELECT h.sec_acct_nbr AS sec_acct, h.sec_cde, v.n, v.d, sum(h.td_end_hold_vol) AS vol FROM "
        + _HELD % ("{szse_cash_event}", "1")
        + f" WHERE {_in('h.sec_acct_nbr', 'h.sec_cde', '1')}"
        + " GROUP BY h.sec_acct_nbr, h.sec_cde, v.day, v.n, v.d) f",
        sal_amt=f"CAST({_half_up('100 * CAST(vol AS HUGEINT) * CAST(n AS HUGEINT)', 'd')} AS DECIMAL(20,0)) * 0.01",
    ),
    "szse_conversion": _ledger(
        "1", "5000",
        f"""(SELECT t.shdr_acct AS sec_acct, {_code('r.sec_cde')} AS sec_cde,
            CAST(t.conv_vol AS DECIMAL(18,2)) AS vol, CAST(r.conv_prc AS DECIMAL(18,3)) AS price
          FROM {{s_conv_bond_trad}} t JOIN {{s_conv_bond_reg}} r
            ON r.conv_bond_cde = t.conv_bond_cde AND r.s_date <= t.prcs_date
              AND r.e_date > t.prcs_date
          WHERE t.biz_sort IN ('30', '31', '32') AND {_period('t.prcs_date')}
          UNION ALL
          SELECT t.shdr_acct, t.sec_cde, CAST(t.setl_vol AS DECIMAL(18,2)), q.cls_prc
          FROM {{s_dtl_result}} t JOIN {{closes}} q ON q.exch = '1' AND q.sec_cde = t.sec_cde
            AND q.day = t.trad_date
          WHERE t.biz_sort = 'ZQZG' AND t.setl_indc = 'Y' AND t.setl_vol > 0
            AND {_period('t.trad_date')}) f
        WHERE {_in('sec_acct', 'sec_cde', '1')}""",
        buy_vol="vol", buy_amt="vol * price",
    ),
    "szse_etf": _ledger(
        "1", "6000",
        """(SELECT c.sec_acct, c.sec_cde, c.vol, q.cls_prc FROM {run_change} c
          JOIN {closes} q ON q.exch = '1' AND q.sec_cde = c.sec_cde AND q.day = c.day
          WHERE c.chg_cde IN ('A88', 'A91', 'A92') AND c.sec_acct <> '0899999004') f""",
        buy_vol="CASE WHEN vol > 0 THEN vol ELSE 0 END",
        sal_vol="CASE WHEN vol < 0 THEN abs(vol) ELSE 0 END",
        buy_amt="CASE WHEN vol > 0 THEN vol * cls_prc ELSE 0 END",
        sal_amt="CASE WHEN vol < 0 THEN abs(vol * cls_prc) ELSE 0 END",
    ),
}

SSE_RULES = [
    "sse_trade", "sse_margin", "sse_transfer", "sse_ipo", "sse_followon", "sse_incentive",
    "sse_rights", "sse_bonus", "sse_dividend", "sse_conversion", "sse_etf",
]
SZSE_RULES = [
    "szse_trade", "szse_transfer", "szse_ipo", "szse_followon", "szse_incentive", "szse_rights",
    "szse_bonus", "szse_dividend", "szse_conversion", "szse_etf",
]


def _gap(exch: str) -> str:
    change = "(coalesce(e.vol, 0) - coalesce(s.vol, 0))"
    return f"""
      SELECT '{exch}' AS exch, sec_acct, sec_cde, '9999' AS biz_type,
             CAST(0 AS DECIMAL(18,3)) AS tax_fee,
             CAST(CASE WHEN gap > 0 THEN gap ELSE 0 END AS DECIMAL(18,0)) AS buy_vol,
             CAST(CASE WHEN gap < 0 THEN -gap ELSE 0 END AS DECIMAL(18,0)) AS sal_vol,
             CAST(CASE WHEN gap > 0 THEN gap * end_prc ELSE 0 END AS DECIMAL(18,2)) AS buy_amt,
             CAST(CASE WHEN gap < 0 THEN -gap * start_prc ELSE 0 END AS DECIMAL(18,2)) AS sal_amt,
             '{BATCH}' AS batch
      FROM (SELECT n.sec_acct, n.sec_cde, b.start_prc, b.end_prc,
                   CAST({change} - n.chg_vol AS DECIMAL(18,0)) AS gap
            FROM {{net}} n JOIN {{bounds}} b ON b.exch = n.exch AND b.sec_cde = n.sec_cde
            LEFT JOIN {{start_held}} s ON s.exch = n.exch AND s.sec_acct = n.sec_acct
              AND s.sec_cde = n.sec_cde
            LEFT JOIN {{end_held}} e ON e.exch = n.exch AND e.sec_acct = n.sec_acct
              AND e.sec_cde = n.sec_cde
            WHERE n.exch = '{exch}' AND (s.sec_acct IS NOT NULL OR e.sec_acct IS NOT NULL)) g
      WHERE gap <> 0"""


def _held_at(day: str) -> str:
    return f"""SELECT b.exch, h.sec_acct_nbr AS sec_acct, h.sec_cde, sum(h.td_end_hold_vol) AS vol
      FROM {{hold_his}} h JOIN {{bounds}} b ON b.exch = h.mkt_sort AND b.sec_cde = h.sec_cde
        AND h.s_date <= b.{day} AND h.e_date > b.{day}
      WHERE {_in('h.sec_acct_nbr')} GROUP BY b.exch, h.sec_acct_nbr, h.sec_cde"""


_WINDOW = f"""day >= (SELECT max(calendar_date) FROM {{tdsum_date_exchange}}
        WHERE is_trd_dt = '1' AND calendar_date <= {S} - INTERVAL 1 YEAR) AND day <= {E}"""
_BOARD = f"""sec_cde IN (SELECT sec_cde FROM {{sec_info}} WHERE s_date <= {E} AND e_date > {E}
        AND sec_ctg = '11' AND mkt_lvl_sort IN ('1', '2', '3') AND mkt_sort = '%s')"""
# The run of the top-ten query: the ranking at the end of the period.
TOP_DAY = E


def _owner_holdings(day: str, ended: str) -> str:
    return f"""SELECT a.oap_acct_nbr, h.sec_cde, sum(h.td_end_hold_vol) AS hold_vol
      FROM {{hold_his}} h JOIN {{intg_sec_acct}} a ON a.sec_acct = h.sec_acct_nbr
        AND a.mkt_sort = h.mkt_sort AND a.s_date <= {day} AND a.e_date > {day}
      WHERE h.s_date <= {day} AND h.e_date {ended} {day}
        AND h.sec_cde IN (SELECT sec_cde FROM {{secs}})
      GROUP BY a.oap_acct_nbr, h.sec_cde"""


def _report(top: str) -> str:
    return f"""
      SELECT l.exch, l.sec_acct, l.sec_cde, a.oap_acct_nbr, a.sec_acct_name AS acct_name,
             coalesce(c.clsf_2, '') AS clsf_2, coalesce(c.clsf_3, '') AS clsf_3,
             CASE WHEN EXISTS (SELECT 1 FROM {{executive}} x WHERE x.oap_acct_nbr = a.oap_acct_nbr
               AND x.sec_cde = l.sec_cde) THEN '1' ELSE '0' END AS is_ods,
             CASE WHEN EXISTS (SELECT 1 FROM {{{top}}} x WHERE x.oap_acct_nbr = a.oap_acct_nbr
               AND x.sec_cde = l.sec_cde) THEN '1' ELSE '0' END AS is_top10_shdr,
             CASE WHEN EXISTS (SELECT 1 FROM {{lockup}} x WHERE x.sec_acct = l.sec_acct
               AND x.sec_cde = l.sec_cde) THEN '1' ELSE '0' END AS is_lift_ban_lmt_shdr,
             CAST(o.bal AS DECIMAL(18,2)) AS start_hld_mkt_val,
             CAST(z.bal AS DECIMAL(18,2)) AS end_hld_mkt_val,
             l.buy_amt, l.sal_amt, l.moved_in AS non_trad_tran_incm_amt,
             l.moved_out AS non_trad_tran_expdt_amt, l.gap_amt AS sprd_stock_estmt_amt,
             l.cash_dvd, CAST(l.tax_fee AS DECIMAL(18,2)) AS tax_fee,
             CAST((l.buy_amt + l.sal_amt) * {RATE} AS DECIMAL(18,2)) AS cmsn,
             CAST(l.sal_amt - l.buy_amt + (z.bal - o.bal) - l.tax_fee
               - (l.buy_amt + l.sal_amt) * {RATE} AS DECIMAL(18,2)) AS brkv_amt,
             '{BATCH}' AS batch
      FROM {{pair_sum}} l
      JOIN {{account_now}} a ON a.sec_acct = l.sec_acct
      LEFT JOIN {{class_now}} c ON c.sec_acct = l.sec_acct
      JOIN {{open_or_zero}} o ON o.exch = l.exch AND o.sec_acct = l.sec_acct AND o.sec_cde = l.sec_cde
      JOIN {{close_or_zero}} z ON z.exch = l.exch AND z.sec_acct = l.sec_acct AND z.sec_cde = l.sec_cde"""


RELATIONS |= {
    "flows": " UNION ALL ".join(f"SELECT * FROM {{{r}}}" for r in SSE_RULES + SZSE_RULES),
    "net": "SELECT exch, sec_acct, sec_cde, sum(buy_vol - sal_vol) AS chg_vol FROM {flows} GROUP BY 1, 2, 3",
    "edge": f"""SELECT exch, sec_cde, min(day) AS start_day, max(day) AS end_day FROM {{closes}}
      WHERE {_period('day')} GROUP BY exch, sec_cde""",
    "market_bounds": """SELECT d.exch, d.sec_cde, d.start_day, f.cls_prc AS start_prc, d.end_day,
        t.cls_prc AS end_prc FROM {edge} d
      JOIN {closes} f ON f.exch = d.exch AND f.sec_cde = d.sec_cde AND f.day = d.start_day
      JOIN {closes} t ON t.exch = d.exch AND t.sec_cde = d.sec_cde AND t.day = d.end_day""",
    "bounds": "SELECT b.* FROM {market_bounds} b JOIN {secs} s ON s.exch = b.exch AND s.sec_cde = b.sec_cde",
    "start_held": _held_at("start_day"),
    "end_held": _held_at("end_day"),
    "sse_gap": _gap("0"),
    "szse_gap": _gap("1"),
    "ledger": "SELECT * FROM {flows} UNION ALL SELECT * FROM {sse_gap} UNION ALL SELECT * FROM {szse_gap}",
    "open_value": """SELECT h.exch, h.sec_acct, h.sec_cde, b.start_prc * h.vol AS bal
      FROM {start_held} h JOIN {bounds} b ON b.exch = h.exch AND b.sec_cde = h.sec_cde""",
    "close_value": """SELECT h.exch, h.sec_acct, h.sec_cde, b.end_prc * h.vol AS bal
      FROM {end_held} h JOIN {bounds} b ON b.exch = h.exch AND b.sec_cde = h.sec_cde""",
    "pair_sum": """SELECT exch, sec_acct, sec_cde, sum(buy_amt) AS buy_amt, sum(sal_amt) AS sal_amt,
        sum(tax_fee) AS tax_fee,
        sum(CASE WHEN biz_type = '2000' THEN sal_amt ELSE 0 END) AS moved_in,
        sum(CASE WHEN biz_type = '2000' THEN buy_amt ELSE 0 END) AS moved_out,
        sum(CASE WHEN biz_type = '9999' THEN buy_amt + sal_amt ELSE 0 END) AS gap_amt,
        sum(CASE WHEN biz_type = '4004' THEN sal_amt ELSE 0 END) AS cash_dvd
      FROM {ledger} GROUP BY exch, sec_acct, sec_cde""",
    "open_or_zero": """SELECT p.exch, p.sec_acct, p.sec_cde, coalesce(v.bal, 0) AS bal
      FROM {pair_sum} p LEFT JOIN {open_value} v
        ON v.exch = p.exch AND v.sec_acct = p.sec_acct AND v.sec_cde = p.sec_cde""",
    "close_or_zero": """SELECT p.exch, p.sec_acct, p.sec_cde, coalesce(v.bal, 0) AS bal
      FROM {pair_sum} p LEFT JOIN {close_value} v
        ON v.exch = p.exch AND v.sec_acct = p.sec_acct AND v.sec_cde = p.sec_cde""",
    "account_now": f"""SELECT a.sec_acct, a.oap_acct_nbr, a.sec_acct_name FROM {{intg_sec_acct}} a
      JOIN (SELECT sec_acct, max(s_date) AS s_date FROM {{intg_sec_acct}} WHERE e_date > {S}
            GROUP BY sec_acct) m ON m.sec_acct = a.sec_acct AND m.s_date = a.s_date
      WHERE a.e_date > {S}""",
    "class_now": f"""SELECT sec_acct_nbr AS sec_acct, clsf_2, clsf_3 FROM {{invst_clsf_his}}
      WHERE s_date <= {E} AND e_date > {E}""",
    "executive": f"""
      SELECT a.oap_acct_nbr, {_code('l.sec_cde')} AS sec_cde FROM {{h_dse_trad_lmt}} l
      JOIN {{intg_sec_acct}} a ON a.sec_acct = l.shdr_acct AND a.mkt_sort = '0'
      WHERE a.s_date <= {E} AND a.e_date > {E}
      UNION
      SELECT a.oap_acct_nbr, rtrim(x.comp_cde) FROM {{szse_excut_info}} x
      JOIN {{intg_sec_acct}} a ON a.cert_nbr = rtrim(x.cert_nbr) AND a.mkt_sort = '1'
        AND a.sec_acct_sort = '1'
      WHERE length(rtrim(x.cert_nbr)) >= 6 AND a.s_date <= {E} AND a.e_date > {E}""",
    "lockup": f"""
      SELECT '0' AS exch, sec_acct, sec_cde FROM (
        SELECT shdr_acct AS sec_acct, {_code('sec_cde')} AS sec_cde, trad_date AS day
        FROM {{h_sec_tran}} WHERE trad_dirc = 'S' AND trans_type = '00G' AND cap_type = 'XL'
          AND equt_type <> 'HL' AND trans_vol <> 0) t
      WHERE {_WINDOW} AND {_in('sec_acct', 'sec_cde')} AND {_BOARD % '0'}
      UNION
      SELECT '1', sec_acct, sec_cde FROM {{change}} k
      WHERE chg_cde = 'A50' AND vol < 0 AND {_WINDOW} AND {_in('sec_acct', 'sec_cde', '1')}
        AND {_BOARD % '1'}
        AND EXISTS (SELECT 1 FROM {{change}} z WHERE z.sec_acct = k.sec_acct
          AND z.sec_cde = k.sec_cde AND z.day = k.day AND z.unit = k.unit AND z.gen = k.gen
          AND z.stk_chrc = '00' AND z.vol > 0 AND z.vol + k.vol = 0)""",
    "literal_holder": _owner_holdings(S, ">="),
    "start_holder": _owner_holdings(S, ">"),
    "end_holder": _owner_holdings(TOP_DAY, ">"),
    "top_holder": """SELECT oap_acct_nbr, sec_cde FROM (SELECT *, rank() OVER (
        PARTITION BY sec_cde ORDER BY hold_vol DESC) AS rank_1 FROM {start_holder}) r WHERE rank_1 <= 10""",
    "report": _report("literal_holder"),
    "report_top": _report("top_holder"),
}

_PLAIN_LEDGER = """SELECT exch, sec_acct, sec_cde, biz_type, CAST(tax_fee AS DOUBLE) AS tax_fee,
  CAST(buy_vol AS BIGINT) AS buy_vol, CAST(sal_vol AS BIGINT) AS sal_vol,
  CAST(buy_amt AS DOUBLE) AS buy_amt, CAST(sal_amt AS DOUBLE) AS sal_amt, batch FROM {%s}"""
_AMOUNTS = [
    "start_hld_mkt_val", "end_hld_mkt_val", "buy_amt", "sal_amt", "non_trad_tran_incm_amt",
    "non_trad_tran_expdt_amt", "sprd_stock_estmt_amt", "cash_dvd", "tax_fee", "cmsn", "brkv_amt",
]

FINAL: dict[str, str] = {
    "q_job_params": f"""SELECT batch, CAST(s_date AS STRING) AS s_date,
      CAST(e_date AS STRING) AS e_date, obj_type, obj_content, invst_sort, invst_content, exch,
      CAST(commission AS DOUBLE) AS commission, exclusion,
      CAST(calc_time AS STRING) AS calc_time, calc_user, status FROM {{job_log}} WHERE batch = '{BATCH}'""",
    "q_list_dedupe": "SELECT DISTINCT item_nbr FROM {security_list}",
    "q_date_range_scan": f"""SELECT CAST(trad_date AS STRING) AS trad_date, count(*) AS n_lines,
      CAST(sum(clr_amt) AS DOUBLE) AS clr_amt FROM {{clr_stm_dtl}}
      WHERE {_period('trad_date')} GROUP BY trad_date""",
    "q_status_latest": """SELECT batch, status FROM (SELECT *, row_number() OVER (
      PARTITION BY batch ORDER BY seq DESC) AS r FROM {status_event}) s WHERE r = 1""",
    "q_unique_check": """SELECT CAST(trad_nbr AS BIGINT) AS trad_nbr, aply_nbr, count(*) AS n_rows
      FROM {clr_stm_dtl} GROUP BY trad_nbr, aply_nbr HAVING count(*) > 1""",
    "q_universe_all": "SELECT sec_cde FROM {codes}",
    "q_universe_board": f"""SELECT DISTINCT sec_cde FROM {{sec_info}}
      WHERE sec_ctg = '11' AND mkt_lvl_sort = '2' AND mkt_sort IN ('0', '1') AND e_date > {S}""",
    "q_universe_list": "SELECT sec_cde FROM {codes} WHERE sec_cde IN (SELECT item_nbr FROM {security_list})",
    "q_universe_exch": "SELECT exch, sec_cde FROM {secs}",
    "q_invest_list": """SELECT DISTINCT '2' AS prmt_type, item_nbr AS prmt_val FROM {account_list}
      WHERE item_nbr IS NOT NULL""",
    "q_invest_expand": f"""
      SELECT DISTINCT '1' AS prmt_type, item_nbr AS prmt_val FROM {{owner_list}}
      WHERE item_nbr IS NOT NULL
      UNION ALL
      SELECT DISTINCT '2', a.sec_acct FROM {{intg_sec_acct}} a
      JOIN {{owner_list}} o ON o.item_nbr = a.oap_acct_nbr
      WHERE trim(a.oap_acct_nbr) <> '' AND a.e_date > {S}""",
    "q_invest_class": f"""SELECT DISTINCT '2' AS prmt_type, a.sec_acct AS prmt_val
      FROM {{intg_sec_acct}} a JOIN {{invst_clsf_his}} c ON c.oap_acct_nbr = a.oap_acct_nbr
      WHERE c.clsf_3 IN ({CLASS_LIST}) AND trim(a.oap_acct_nbr) <> '' AND a.e_date > {S}
        AND c.s_date <= {E} AND c.e_date > {E}""",
    **{f"q_{name}": _PLAIN_LEDGER % name for name in [*SSE_RULES, *SZSE_RULES, "sse_gap", "szse_gap"]},
    "q_quote_bounds": """SELECT exch, sec_cde, CAST(start_day AS STRING) AS start_day,
      CAST(start_prc AS DOUBLE) AS start_prc, CAST(end_day AS STRING) AS end_day,
      CAST(end_prc AS DOUBLE) AS end_prc FROM {market_bounds}""",
    "q_holding_asof": """
      SELECT h.exch, h.sec_acct, h.sec_cde, CAST(b.start_day AS STRING) AS ask_date,
             CAST(h.vol AS BIGINT) AS hold_vol
      FROM {start_held} h JOIN {bounds} b ON b.exch = h.exch AND b.sec_cde = h.sec_cde
      UNION
      SELECT h.exch, h.sec_acct, h.sec_cde, CAST(b.end_day AS STRING), CAST(h.vol AS BIGINT)
      FROM {end_held} h JOIN {bounds} b ON b.exch = h.exch AND b.sec_cde = h.sec_cde""",
    "q_open_value": "SELECT exch, sec_acct, sec_cde, CAST(bal AS DOUBLE) AS start_bal FROM {open_value}",
    "q_close_value": "SELECT exch, sec_acct, sec_cde, CAST(bal AS DOUBLE) AS end_bal FROM {close_value}",
    "q_net_change": "SELECT exch, sec_acct, sec_cde, CAST(chg_vol AS BIGINT) AS chg_vol FROM {net}",
    "q_ledger_all": _PLAIN_LEDGER % "ledger",
    "q_latest_account": "SELECT sec_acct, oap_acct_nbr, sec_acct_name FROM {account_now}",
    "q_class_asof": "SELECT sec_acct, clsf_2, clsf_3 FROM {class_now}",
    "q_flag_executive": "SELECT DISTINCT oap_acct_nbr, sec_cde FROM {executive}",
    "q_flag_lockup": "SELECT DISTINCT exch, sec_acct, sec_cde FROM {lockup}",
    "q_top10_holder": """SELECT oap_acct_nbr, sec_cde, CAST(hold_vol AS BIGINT) AS hold_vol, rank_1
      FROM (SELECT *, rank() OVER (PARTITION BY sec_cde ORDER BY hold_vol DESC) AS rank_1
            FROM {end_holder}) r WHERE rank_1 <= 10""",
    "q_flag_top10_literal": "SELECT oap_acct_nbr, sec_cde FROM {literal_holder}",
    "q_biz_pivot": """SELECT exch, sec_acct, sec_cde, CAST(moved_in AS DOUBLE) AS non_trad_tran_incm_amt,
      CAST(moved_out AS DOUBLE) AS non_trad_tran_expdt_amt,
      CAST(gap_amt AS DOUBLE) AS sprd_stock_estmt_amt, CAST(cash_dvd AS DOUBLE) AS cash_dvd
      FROM {pair_sum}""",
    "q_commission": f"""SELECT exch, sec_acct, sec_cde,
      CAST(CAST((buy_amt + sal_amt) * {RATE} AS DECIMAL(18,2)) AS DOUBLE) AS cmsn FROM {{pair_sum}}""",
    "q_profit": """SELECT exch, sec_cde, is_top10_shdr, CAST(sum(brkv_amt) AS DOUBLE) AS brkv_amt,
      count(*) AS n_accounts FROM {report_top} GROUP BY exch, sec_cde, is_top10_shdr""",
    "q_final_report": "SELECT exch, sec_acct, sec_cde, oap_acct_nbr, acct_name, clsf_2, clsf_3, is_ods,"
    " is_top10_shdr, is_lift_ban_lmt_shdr, "
    + ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in _AMOUNTS)
    + ", batch FROM {report}",
}


# The whole runs: the same relations over the accounts and codes of uploaded lists.
FINAL |= {
    "q_batch_report": FINAL["q_final_report"],
    "q_batch_ledger": FINAL["q_ledger_all"],
    "q_batch_investors": FINAL["q_invest_class"].replace("a.sec_acct AS prmt_val", "a.sec_acct AS prmt_val, '1' AS status"),
}
OWN_RELATIONS: dict[str, dict[str, str]] = {
    "q_batch_report": {
        "accts": "SELECT DISTINCT item_nbr AS sec_acct FROM {account_list} WHERE item_nbr IS NOT NULL",
        "codes": RELATIONS["codes"] + " AND sec_cde IN (SELECT item_nbr FROM {security_list})",
    },
    "q_batch_ledger": {
        "accts": f"""SELECT DISTINCT a.sec_acct FROM {{intg_sec_acct}} a
          JOIN {{owner_list}} o ON o.item_nbr = a.oap_acct_nbr
          WHERE trim(a.oap_acct_nbr) <> '' AND a.e_date > {S}""",
    },
}


def statement(name: str) -> str:
    """One self-contained statement: the relations a query needs, in order, then the query."""
    known = VIEWS | RELATIONS | OWN_RELATIONS.get(name, {})
    order: list[str] = []

    def add(text: str) -> None:
        for ref in references(text):
            if ref in known and ref not in order:
                add(known[ref])
                order.append(ref)

    add(FINAL[name])
    parts = ",\n".join(f"v_{ref} AS ({_plain_names(known[ref], known)})" for ref in order)
    return (f"WITH {parts}\n" if parts else "") + _plain_names(FINAL[name], known)


def _plain_names(text: str, known: dict[str, str]) -> str:
    for ref in references(text):
        text = text.replace(f"{{{ref}}}", f"v_{ref}" if ref in known else ref)
    return text


def oracle_sql() -> dict[str, str]:
    return {name: statement(name) for name in FINAL}
