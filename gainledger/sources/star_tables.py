"""The securities source tables, derived from the given star-schema tables.

There is no securities data to test on, so every source is a projection of whole given tables:
one lineitem row is one business line, a supplier holds one account per exchange, a part is an
instrument. No table is cut by key ranges; everything grows with the given data.

Each view is one SQL text that Spark and the checking engine both run, so a difference in a
query's result comes from the query and not from its inputs. `{name}` refers to another view
or to a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import Workspace

GIVEN = ("customer", "supplier", "part", "orders", "lineitem", "events")

# Where the two generations of the exchange-1 change tables meet in the derived data.
CUTOVER = "1998-07-01"


def _code(x: str) -> str:
    text = f"CAST({x} AS STRING)"
    return f"lpad({text}, CAST(greatest(6, length({text})) AS INT), '0')"


def _padded(x: str) -> str:
    text = f"CAST({x} AS STRING)"
    return f"lpad({text}, CAST(greatest(9, length({text})) AS INT), '0')"


# Holders that have one of the accounts which some rules leave out.
LEFT_OUT = {
    ("0", 2): "B880810718",
    ("0", 3): "B880859746",
    ("0", 5): "B880969127",
    ("0", 6): "B880969135",
    ("0", 7): "B880048866",
    ("0", 9): "B882696518",
    ("1", 4): "0899999004",
}


def _account(exch: str, holder: str) -> str:
    """Exchange 1 accounts start with 0; exchange 0 accounts with E (credit) or A."""
    left_out = " ".join(f"WHEN {exch} = '{e}' AND ({holder}) = {h} THEN '{a}'" for (e, h), a in LEFT_OUT.items())
    return (
        f"(CASE {left_out} ELSE CASE WHEN {exch} = '1' THEN '0' WHEN ({holder}) % 4 = 0 THEN 'E'"
        f" ELSE 'A' END || {_padded(holder)} END)"
    )


def _owner(holder: str) -> str:
    """Two neighbouring holders share one owner; every 13th holder has none on record."""
    return (
        f"(CASE WHEN ({holder}) % 13 = 12 THEN '' ELSE 'O' || "
        f"{_padded(f'CAST(floor(({holder}) / 2) AS BIGINT)')} END)"
    )


def _certificate(holder: str) -> str:
    """Every 7th holder has a certificate number too short to count."""
    return f"(CASE WHEN ({holder}) % 7 = 6 THEN 'X1' ELSE 'ID' || {_padded(holder)} END)"


def _one_of(number: str, codes: list[str]) -> str:
    """The codes in turn by a number (halved: the instruments of an exchange are all odd or even)."""
    half = f"CAST(floor(({number}) / 2) AS BIGINT) % {len(codes)}"
    return f"CASE {half} " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(codes)) + " END"


_SIGNED_VOL = "CASE WHEN side = 'B' THEN vol ELSE -vol END"
_NO_FEE = "CAST(0 AS DECIMAL(18,2))"


def _changes(issue_code: str, period: str) -> str:
    """Holding changes of exchange 1; an unlocking (line 7) has its mirror row."""
    return f"""
      SELECT day AS chg_date, {_account("'1'", 'holder')} AS shdr_acct, sec_int, sec_cde,
             CAST(line AS STRING) AS unit,
             CASE WHEN line = 1 AND disc >= 0.05 THEN '02' WHEN line = 7 THEN '01' ELSE '00' END
               AS stk_chrc,
             CASE line WHEN 1 THEN '{issue_code}' WHEN 2 THEN 'A42'
                  WHEN 3 THEN CASE WHEN disc < 0.05 THEN 'A40' ELSE 'A39' END
                  WHEN 4 THEN {_one_of("sec_int", ['A88', 'A91', 'A92'])}
                  WHEN 5 THEN {_one_of("sec_int", ['A0A', 'AOC', 'A4A', 'A69', 'A72', 'A76'])}
                  WHEN 6 THEN {_one_of("sec_int", ['R04', 'R05', 'R06', 'A77', 'A89'])}
                  ELSE 'A50' END AS chg_cde,
             CASE WHEN line < 4 THEN vol WHEN line = 7 OR side = 'S' THEN -vol ELSE vol END
               AS chg_vol
      FROM {{line}} WHERE flag = 'A' AND exch = '1' AND day {period}
      UNION ALL
      SELECT day, {_account("'1'", 'holder')}, sec_int, sec_cde, CAST(line AS STRING),
             CASE WHEN disc < 0.05 THEN '00' ELSE '05' END, 'A51', vol
      FROM {{line}} WHERE flag = 'A' AND exch = '1' AND line = 7 AND day {period}"""


VIEWS: dict[str, str] = {
    # One business line; the base of all flow tables.
    "line": f"""
      SELECT CAST(l_partkey % 2 AS STRING) AS exch, l_partkey AS sec_int,
             {_code('l_partkey')} AS sec_cde, l_suppkey AS holder, l_orderkey AS nbr,
             l_linenumber AS line, CAST(l_shipdate AS DATE) AS day,
             CASE WHEN l_linestatus = 'O' THEN 'B' ELSE 'S' END AS side, l_returnflag AS flag,
             CAST(l_quantity AS DECIMAL(18,0)) AS vol,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
             CAST(l_tax AS DECIMAL(4,2)) AS tax, CAST(l_discount AS DECIMAL(4,2)) AS disc
      FROM {{lineitem}}""",
    "holder": """
      SELECT '0' AS exch, s_suppkey AS holder, s_name AS name, s_nationkey AS nation FROM {supplier}
      UNION ALL
      SELECT '1', s_suppkey, s_name, s_nationkey FROM {supplier}""",
    # --- masters -------------------------------------------------------------------------
    "sec_info": f"""
      SELECT CAST(p_partkey % 2 AS STRING) AS mkt_sort, {_code('p_partkey')} AS sec_cde,
             CAST(p_partkey % 3 + 1 AS STRING) AS mkt_lvl_sort,
             CASE WHEN p_type = 'PROMO' THEN '21' ELSE '11' END AS sec_ctg,
             DATE '1990-01-01' AS s_date,
             CASE WHEN p_size > 45 THEN DATE '1995-12-31' WHEN p_size % 5 = 0
                  THEN DATE '1998-01-01' ELSE DATE '3000-12-31' END AS e_date
      FROM {{part}}
      UNION ALL
      SELECT CAST(p_partkey % 2 AS STRING), {_code('p_partkey')},
             CAST((p_partkey + 1) % 3 + 1 AS STRING),
             CASE WHEN p_type = 'PROMO' THEN '21' ELSE '11' END,
             DATE '1998-01-01', DATE '3000-12-31'
      FROM {{part}} WHERE p_size <= 45 AND p_size % 5 = 0""",
    "intg_sec_acct": f"""
      SELECT {_account('exch', 'holder')} AS sec_acct,
             CASE WHEN nation < 15 THEN '1' ELSE '2' END AS sec_acct_sort, exch AS mkt_sort,
             name AS sec_acct_name, {_certificate('holder')} AS cert_nbr,
             {_owner('holder')} AS oap_acct_nbr, DATE '1990-01-01' AS s_date,
             CASE WHEN holder % 11 = 10 THEN DATE '1995-12-31' WHEN holder % 5 = 0
                  THEN DATE '1998-06-30' ELSE DATE '3000-12-31' END AS e_date
      FROM {{holder}}
      UNION ALL
      SELECT {_account('exch', 'holder')}, CASE WHEN nation < 15 THEN '1' ELSE '2' END, exch,
             name || '-v2', {_certificate('holder')}, {_owner('holder')},
             DATE '1998-06-30', DATE '3000-12-31'
      FROM {{holder}} WHERE holder % 11 <> 10 AND holder % 5 = 0""",
    "invst_clsf_his": f"""
      SELECT {_owner('holder')} AS oap_acct_nbr, {_account('exch', 'holder')} AS sec_acct_nbr,
             CASE WHEN nation < 12 THEN '2800' ELSE '1500' END AS clsf_2,
             CASE WHEN nation < 6 THEN '2810' WHEN nation < 12 THEN '2310'
                  WHEN nation < 18 THEN '1110' ELSE '1990' END AS clsf_3,
             DATE '1990-01-01' AS s_date,
             CASE WHEN holder % 3 = 0 THEN DATE '1999-06-30' ELSE DATE '3000-12-31' END AS e_date
      FROM {{holder}} WHERE nation <> 24
      UNION ALL
      SELECT {_owner('holder')}, {_account('exch', 'holder')}, '1500', '1540',
             DATE '1999-06-30', DATE '3000-12-31'
      FROM {{holder}} WHERE nation <> 24 AND holder % 3 = 0""",
    "stm_acct_setup_his": f"""
      SELECT CASE WHEN holder % 10 = 0 THEN 'RQ' ELSE 'PT' END AS acct_sort,
             {_account("'0'", 'holder')} AS sec_setl_acct,
             DATE '1997-03-01' AS s_date, DATE '1998-09-01' AS e_date
      FROM {{holder}} WHERE exch = '0'""",
    "s_crdt_seat_acct_his": f"""
      SELECT {_account("'1'", 'holder')} AS sec_ln_broker_acct,
             DATE '1997-03-01' AS s_date, DATE '1998-09-01' AS e_date
      FROM {{holder}} WHERE exch = '1' AND name LIKE '%7'""",
    "tdsum_date_exchange": """
      SELECT DISTINCT CAST(o_orderdate AS DATE) AS calendar_date,
             CASE WHEN day(CAST(o_orderdate AS DATE)) % 7 <> 0 THEN '1' ELSE '0' END AS is_trd_dt
      FROM {orders}""",
    "sec_quot": """
      SELECT exch AS sec_exch_cde, sec_cde, day AS trad_date,
             CAST(max(amt) AS DECIMAL(18,3)) AS cls_prc
      FROM {line} GROUP BY exch, sec_cde, day""",
    # Running position per account, security and custody unit. The ordered pass sees one row per
    # day of a position, so its longest group is bounded by the days of history.
    "hold_his": f"""
      SELECT exch AS mkt_sort, {_account('exch', 'holder')} AS sec_acct_nbr, unit AS cstd_unit_id,
             {_code('sec_int')} AS sec_cde, 'PT' AS cap_type,
             CAST(500 + sum(net) OVER (PARTITION BY exch, holder, sec_int, unit ORDER BY day
               ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,0)) AS td_end_hold_vol,
             day AS s_date,
             coalesce(lead(day) OVER (PARTITION BY exch, holder, sec_int, unit ORDER BY day),
               DATE '3000-12-31') AS e_date
      FROM (SELECT exch, holder, sec_int, CASE WHEN line < 4 THEN 'U1' ELSE 'U2' END AS unit, day,
                   sum({_SIGNED_VOL}) AS net
            FROM {{line}} WHERE flag IN ('N', 'R')
            GROUP BY exch, holder, sec_int, CASE WHEN line < 4 THEN 'U1' ELSE 'U2' END, day) AS d""",
    # --- exchange 0 flows ----------------------------------------------------------------
    "clr_stm_dtl": f"""
      SELECT {_account("'0'", 'holder')} AS shdr_acct,
             CASE flag WHEN 'N' THEN '001' WHEN 'R' THEN '003' ELSE '002' END AS rcod_type,
             nbr AS trad_nbr, CASE WHEN disc = 0.10 THEN '002' ELSE '001' END AS biz_sort,
             '00A' AS trans_type, CAST(line AS STRING) AS aply_nbr, day AS trad_date,
             sec_int AS sec_cde1, CASE WHEN flag = 'A' THEN 'GZ' ELSE 'PT' END AS sec_ctg,
             side AS trad_dirc, {_SIGNED_VOL} AS setl_vol,
             CASE WHEN side = 'B' THEN -amt ELSE amt END AS clr_amt,
             CAST(CASE WHEN side = 'S' THEN -(amt * 0.001) ELSE 0 END AS DECIMAL(18,3)) AS stmp_tax,
             CAST(-(amt * tax) AS DECIMAL(18,3)) AS hand_fee,
             CAST(-(vol * 0.002) AS DECIMAL(18,3)) AS tran_fee,
             CAST(-(vol * 0.01) AS DECIMAL(18,2)) AS cmsn_chg,
             CAST(0 AS DECIMAL(18,3)) AS admin_chrg,
             {_NO_FEE} AS oth_amt1, {_NO_FEE} AS oth_amt2, {_NO_FEE} AS oth_amt3,
             CASE WHEN line = 7 THEN '8001' ELSE '0000' END AS result_cde
      FROM {{line}} WHERE exch = '0'""",
    "h_sec_trad": f"""
      SELECT nbr AS trad_nbr, day AS trad_date, sec_int AS sec_cde,
             {_account("'0'", 'holder')} AS b_shr_acct, CAST(line AS STRING) AS buy_aply_nbr,
             {_account("'0'", 'holder + 1')} AS sal_shdr_acct, CAST(line AS STRING) AS sal_aply_nbr,
             CAST(line AS STRING) || CAST(line AS STRING) AS memo
      FROM {{line}} WHERE exch = '0' AND flag = 'R'""",
    "h_non_trad_tran": f"""
      SELECT day AS trans_date,
             CASE WHEN line = 7 THEN 'TWY' ELSE 'T' END || CAST(nbr AS STRING) AS aply_nbr,
             {_account("'0'", 'holder')} AS ata, {_account("'0'", 'holder + 1')} AS in_acct,
             sec_int AS sec_cde, CASE WHEN disc = 0.10 THEN 'XL' ELSE 'PT' END AS cap_type,
             vol AS trans_vol,
             CAST(CASE WHEN line % 2 = 0 THEN 0 ELSE amt END AS DECIMAL(18,6)) AS tran_prc,
             CAST(amt * tax AS DECIMAL(18,3)) AS tran_fee,
             CAST(amt * 0.001 AS DECIMAL(18,3)) AS stmp_tax,
             CAST(vol * 0.01 AS DECIMAL(18,2)) AS cmsn_chg,
             CASE WHEN line = 3 THEN '1' ELSE '0' END AS succ_indc
      FROM {{line}} WHERE exch = '0' AND flag = 'R'""",
    # Lines 4 and 5 are the two legs of a bond conversion and share a date per order.
    "h_sec_tran": f"""
      SELECT CASE WHEN line IN (4, 5) THEN DATE '1995-01-01' + CAST(nbr % 2400 AS INT)
                  ELSE day END AS trad_date,
             nbr AS trad_nbr,
             CASE WHEN line = 4 THEN 'S' WHEN line = 6 THEN side WHEN line = 7 THEN 'S' ELSE 'B' END
               AS trad_dirc,
             {_account("'0'", 'holder')} AS shdr_acct,
             CASE WHEN line = 3 THEN sec_int + 500000000 ELSE sec_int END AS sec_cde,
             CASE line WHEN 3 THEN 'PG' WHEN 4 THEN 'GZ' WHEN 5 THEN 'PT' WHEN 6 THEN 'PT'
                  ELSE 'XL' END AS cap_type,
             CASE line WHEN 1 THEN 'F' WHEN 2 THEN 'C' ELSE 'A' END AS negt_type,
             CASE WHEN disc = 0.10 THEN 'HL' ELSE '' END AS equt_type,
             CASE line WHEN 1 THEN '00F' WHEN 2 THEN '00F' WHEN 3 THEN '00A' WHEN 6 THEN '007'
                  WHEN 7 THEN '00G' ELSE '00Y' END AS trans_type,
             vol AS trans_vol, CAST(amt AS DECIMAL(18,6)) AS tran_prc,
             CAST(nbr % 86400 AS INT) AS trad_time, CAST(nbr AS STRING) AS aply_nbr
      FROM {{line}} WHERE exch = '0' AND flag = 'A'""",
    "ipo_iss_info": f"""
      SELECT {_code('p_partkey')} AS stk_cde,
             DATE '1996-02-01' + CAST(p_partkey % 1700 AS INT) AS list_date,
             CAST(p_partkey % 2 AS STRING) AS sec_exch_cde,
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(24,6)) AS iss_prc
      FROM {{part}}""",
    "sse_stk_fi_info": """
      SELECT CASE WHEN holder % 6 = 5 THEN '' ELSE sec_cde END AS stk_cde, day AS iss_date,
             CAST(amt AS DECIMAL(18,5)) AS iss_prc,
             CASE WHEN disc = 0.10 THEN DATE '1999-01-01' ELSE DATE '3000-12-31' END AS e_date
      FROM {line} WHERE exch = '0' AND flag = 'A' AND line = 1""",
    # Rights codes of the years that have rights lines, bonus shares, and cash dividends; every
    # second dividend falls on the record date of the bonus.
    "h_eqt_reg": """
      SELECT 'PG' AS reg_sort, sec_int AS sec_cde, sec_int + 500000000 AS iss_cde,
             '' AS equt_type, CAST(year(day) AS SMALLINT) AS equt_years,
             DATE '1996-01-31' AS reg_date, CAST(0 AS DECIMAL(18,6)) AS bef_tax_divd,
             CAST(10 AS DECIMAL(18,6)) AS allot_denom, CAST(3 AS DECIMAL(18,6)) AS allot_numrt,
             '1' AS mkup_indc, 'rights' AS rmak_desc
      FROM {line} WHERE exch = '0' AND flag = 'A' AND line = 3 AND disc < 0.09
      UNION ALL
      SELECT 'SG', p_partkey, p_partkey, 'SG', CAST(1997 AS SMALLINT),
             DATE '1996-03-01' + CAST(p_partkey % 1700 AS INT), CAST(0 AS DECIMAL(18,6)),
             CAST(10 AS DECIMAL(18,6)), CAST(p_size % 5 + 1 AS DECIMAL(18,6)), '0',
             CASE WHEN p_size % 12 = 7 THEN '股改对价' ELSE 'bonus' END
      FROM {part} WHERE p_partkey % 2 = 0
      UNION ALL
      SELECT 'HL', p_partkey, p_partkey, 'HL', CAST(1997 AS SMALLINT),
             DATE '1996-03-01' + CAST((p_partkey + CASE WHEN p_size % 2 = 0 THEN 0 ELSE 45 END)
               % 1700 AS INT),
             CAST(p_size * 10 AS DECIMAL(18,6)), CAST(10 AS DECIMAL(18,6)),
             CAST(0 AS DECIMAL(18,6)), CASE WHEN p_size % 9 = 8 THEN '0' ELSE '1' END, 'cash'
      FROM {part} WHERE p_partkey % 2 = 0""",
    "h_dse_trad_lmt": f"""
      SELECT {_account("'0'", 'holder')} AS shdr_acct, sec_int AS sec_cde
      FROM {{line}} WHERE exch = '0' AND flag = 'A' AND line = 6""",
    # --- exchange 1 flows ----------------------------------------------------------------
    "s_clr_trans_trad": f"""
      SELECT {_account("'1'", 'holder')} AS shdr_acct, sec_int AS sec_cde, day AS trad_date,
             CASE WHEN side = 'B' THEN vol ELSE 0 END AS buy_vol,
             CASE WHEN side = 'S' THEN vol ELSE 0 END AS sal_vol,
             CAST(CASE WHEN side = 'B' THEN amt ELSE 0 END AS DECIMAL(18,3)) AS buy_amt,
             CAST(CASE WHEN side = 'S' THEN amt ELSE 0 END AS DECIMAL(18,3)) AS sal_amt,
             CAST(CASE WHEN side = 'B' THEN amt * tax END AS DECIMAL(18,2)) AS buy_hand_fee,
             CAST(NULL AS DECIMAL(18,2)) AS buy_stmp_tax,
             CAST(vol * 0.02 AS DECIMAL(18,2)) AS buy_tran_fee, {_NO_FEE} AS buy_cmsn_chg,
             CAST(CASE WHEN side = 'S' THEN amt * tax END AS DECIMAL(18,2)) AS sal_hand_fee,
             CAST(CASE WHEN side = 'S' THEN amt * 0.001 END AS DECIMAL(18,2)) AS sal_stmp_tax,
             {_NO_FEE} AS sal_tran_fee, CAST(NULL AS DECIMAL(18,2)) AS sal_cmsn_chg
      FROM {{line}} WHERE exch = '1' AND flag IN ('N', 'R')""",
    "s_shdr_hld_chg": f"""
      SELECT chg_date, shdr_acct, sec_int AS sec_cde, unit AS seat_cde, stk_chrc, chg_cde, chg_vol
      FROM ({_changes('A30', f"< DATE '{CUTOVER}'")}) AS c""",
    "s_stk_chg": f"""
      SELECT chg_date, shdr_acct, sec_cde, unit AS cstd_unit, stk_chrc, chg_cde,
             CAST(chg_vol AS DECIMAL(17,2)) AS chg_vol
      FROM ({_changes('A44', f">= DATE '{CUTOVER}'")}) AS c""",
    "szse_stk_fi_info": """
      SELECT sec_cde AS stk_cde, day + 1 AS fi_list_date, CAST(amt AS DECIMAL(9,3)) AS iss_prc
      FROM {line} WHERE exch = '1' AND flag = 'A' AND line = 1""",
    "s_right_prmt_his": """
      SELECT CAST(CASE WHEN disc = 0.10 THEN 0 ELSE amt END AS DECIMAL(13,4)) AS subsc_prc,
             sec_cde AS conv_sec_cde, day AS right_arrv_date,
             CASE WHEN disc = 0.09 THEN DATE '1999-01-01' ELSE DATE '3000-12-31' END AS e_date
      FROM {line} WHERE exch = '1' AND flag = 'A' AND line = 2""",
    "s_divd_prmt_his": """
      SELECT 'D' || CAST(p_partkey AS STRING) AS biz_nbr,
             CASE WHEN p_size = 49 THEN 'SG' ELSE 'HL' END AS equt_sort,
             CASE WHEN p_size = 47 THEN '01' ELSE '00' END AS stk_chrc,
             CAST(p_size AS DECIMAL(25,10)) AS bef_tax_rate_numrt,
             CAST(p_size % 3 + 8 AS DECIMAL(25,10)) AS bef_tax_rate_denom,
             CASE WHEN p_size = 48 THEN 'N' ELSE 'Y' END AS prcs_sts, DATE '3000-12-31' AS e_date
      FROM {part} WHERE p_partkey % 2 = 1""",
    "s_equt_prmt_his": f"""
      SELECT {_code('p_partkey')} AS sec_cde, 'D' || CAST(p_partkey AS STRING) AS biz_nbr,
             DATE '1996-03-01' + CAST(p_partkey % 1700 AS INT) AS equity_reg_date,
             DATE '3000-12-31' AS e_date
      FROM {{part}} WHERE p_partkey % 2 = 1""",
    "s_conv_bond_trad": f"""
      SELECT sec_int + 100000000 AS conv_bond_cde, {_account("'1'", 'holder')} AS shdr_acct,
             day AS prcs_date, vol AS conv_vol,
             CASE WHEN disc < 0.04 THEN '30' WHEN disc < 0.07 THEN '31' WHEN disc < 0.10 THEN '32'
                  ELSE '39' END AS biz_sort
      FROM {{line}} WHERE exch = '1' AND flag = 'N' AND line = 7""",
    "s_conv_bond_reg": """
      SELECT p_partkey + 100000000 AS conv_bond_cde, p_partkey AS sec_cde,
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS conv_prc,
             DATE '1990-01-01' AS s_date, DATE '1998-01-01' AS e_date
      FROM {part} WHERE p_partkey % 2 = 1
      UNION ALL
      SELECT p_partkey + 100000000, p_partkey,
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)),
             DATE '1998-01-01', DATE '3000-12-31'
      FROM {part} WHERE p_partkey % 2 = 1""",
    "s_dtl_result": f"""
      SELECT {_account("'1'", 'holder')} AS shdr_acct,
             CASE WHEN disc = 0.10 THEN 'ZQHS' ELSE 'ZQZG' END AS biz_sort, sec_cde,
             CAST({_SIGNED_VOL} AS DECIMAL(30,2)) AS setl_vol,
             CASE WHEN disc = 0.09 THEN 'N' ELSE 'Y' END AS setl_indc, day AS trad_date
      FROM {{line}} WHERE exch = '1' AND flag = 'N' AND line = 6""",
    "szse_excut_info": f"""
      SELECT sec_cde || '  ' AS comp_cde, {_certificate('holder')} || '    ' AS cert_nbr
      FROM {{line}} WHERE exch = '1' AND flag = 'A' AND line = 6""",
    # --- jobs, status events, upload lists -------------------------------------------------
    "job_log": f"""
      SELECT {_code('o_orderkey')} AS batch, CAST(o_orderdate AS DATE) AS s_date,
             CAST(o_orderdate AS DATE) + 365 AS e_date,
             CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '1' END AS obj_type,
             CASE WHEN o_orderstatus = 'O' THEN '11' WHEN o_orderstatus = 'P' THEN '1'
                  ELSE 'instruments.txt' END AS obj_content,
             CASE WHEN o_custkey % 2 = 0 THEN '3' ELSE '2' END AS invst_sort,
             CASE WHEN o_custkey % 2 = 0 THEN '2810,2310,1110,1540' ELSE 'accounts.txt' END
               AS invst_content,
             CASE WHEN o_custkey % 3 = 2 THEN '3' ELSE CAST(o_custkey % 3 AS STRING) END AS exch,
             CAST(0.002 AS DECIMAL(6,5)) AS commission, '00000000' AS exclusion,
             CAST(o_orderdate AS TIMESTAMP) AS calc_time, 'user1' AS calc_user, '0' AS status
      FROM {{orders}}""",
    "status_event": f"""
      SELECT {_code('user_id')} AS batch, event_id AS seq,
             CASE event_type WHEN 'error' THEN '2' WHEN 'purchase' THEN '1' ELSE '0' END AS status
      FROM {{events}}""",
    "security_list": "SELECT sec_cde AS item_nbr FROM {line} WHERE flag = 'R'",
    "account_list": f"SELECT {_account('exch', 'holder')} AS item_nbr FROM {{line}}",
    "owner_list": f"""
      SELECT CASE WHEN {_owner('holder')} = '' THEN CAST(NULL AS STRING) ELSE {_owner('holder')} END
        AS item_nbr FROM {{line}} WHERE flag = 'A'""",
}

# The keys that the sums and the windows of a view share: its lines are dealt by these, once.
DEALT_BY = {"hold_his": ("exch", "holder", "sec_int")}

_REFERENCE = re.compile(r"\{(\w+)\}")


def references(text: str) -> list[str]:
    """Names in braces, in order of first use."""
    return list(dict.fromkeys(_REFERENCE.findall(text)))


class StarTables:
    """Source tables over a folder of given Parquet tables."""

    cutover = CUTOVER

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._views: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._views:
            if name in VIEWS:
                text = VIEWS[name]
                inputs = {ref: self.table(ref) for ref in references(text)}
                if name in DEALT_BY:
                    # Whole volumes of at most 18 digits: their sums are quicker as longs.
                    lines = inputs["line"].withColumn("vol", F.col("vol").cast("bigint"))
                    inputs["line"] = lines.repartition(*DEALT_BY[name])
                self._views[name] = self.spark.sql(text, **inputs)
            else:
                self._views[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._views[name]

    def with_stored_lines(self, work: Workspace) -> StarTables:
        """The same tables over a stored copy of all business lines.

        A whole run reads the lines for every source table; stored once, their codes, days and
        decimals are not made again from the given columns by each of them. Most source tables
        take the lines of one exchange and flag, so these have folders.
        """
        tables = StarTables(self.spark, self.folder)
        tables._views["line"] = work.store(self.table("line"), "line", ["exch", "flag"])
        return tables
