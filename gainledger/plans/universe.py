"""Which instruments and accounts a run covers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_blank
from ..operators.temporal import valid_on

A_SHARE = "11"
BOARDS = ("1", "2", "3")  # main, small and medium, growth
OWNER, ACCOUNT = "1", "2"  # what an uploaded account list contains


def _a_shares(sec_info: DataFrame, start: date, exchanges: Sequence[str]) -> DataFrame:
    return sec_info.filter(
        (F.col("sec_ctg") == A_SHARE)
        & F.col("mkt_sort").isin(list(exchanges))
        & (F.col("e_date") > F.lit(start))
    )


def all_shares(sec_info: DataFrame, start: date, exchanges: Sequence[str]) -> DataFrame:
    """Every A-share on the exchanges still listed after the start date."""
    return _a_shares(sec_info, start, exchanges).select("sec_cde").distinct()


def board_shares(sec_info: DataFrame, start: date, exchanges: Sequence[str], board: str) -> DataFrame:
    """The A-shares of one board."""
    rows = _a_shares(sec_info, start, exchanges).filter(F.col("mkt_lvl_sort") == board)
    return rows.select("sec_cde").distinct()


def listed_shares(
    sec_info: DataFrame, start: date, exchanges: Sequence[str], items: DataFrame
) -> DataFrame:
    """The A-shares named in an uploaded list."""
    named = items.select(F.col("item_nbr").alias("sec_cde"))
    return all_shares(sec_info, start, exchanges).join(named, "sec_cde", "left_semi")


def exchange_instruments(sec_info: DataFrame, start: date, codes: DataFrame) -> DataFrame:
    """(exch, sec_cde) of the chosen codes, for every exchange that lists them."""
    return (
        sec_info.filter(F.col("e_date") > F.lit(start))
        .select(F.col("mkt_sort").alias("exch"), "sec_cde")
        .distinct()
        .join(codes, "sec_cde", "left_semi")
        .select("exch", "sec_cde")
    )


def uploaded_investors(items: DataFrame, kind: str) -> DataFrame:
    """(prmt_type, prmt_val) of an uploaded list, empty lines dropped."""
    return items.filter(F.col("item_nbr").isNotNull()).select(
        F.lit(kind).alias("prmt_type"), F.col("item_nbr").alias("prmt_val")
    )


def accounts_of_owners(accounts: DataFrame, owners: DataFrame, start: date) -> DataFrame:
    """Accounts of the uploaded owners that are open after the start date, as type 2 rows."""
    wanted = owners.filter(F.col("prmt_type") == OWNER).select(F.col("prmt_val").alias("oap_acct_nbr"))
    return (
        accounts.filter(~is_blank(F.col("oap_acct_nbr")) & (F.col("e_date") > F.lit(start)))
        .join(wanted, "oap_acct_nbr", "left_semi")
        .select(F.lit(ACCOUNT).alias("prmt_type"), F.col("sec_acct").alias("prmt_val"))
        .distinct()
    )


def investors_from_list(accounts: DataFrame, items: DataFrame, kind: str, start: date) -> DataFrame:
    """The uploaded rows and, for owners, the accounts behind them."""
    uploaded = uploaded_investors(items, kind)
    return uploaded.unionByName(accounts_of_owners(accounts, uploaded, start))


def investors_of_classes(
    accounts: DataFrame, classes: DataFrame, wanted: Sequence[str], start: date, end: date
) -> DataFrame:
    """Accounts open after the start whose owner is in one of the classes on the end date."""
    owners = classes.filter(valid_on(end) & F.col("clsf_3").isin(list(wanted))).select("oap_acct_nbr")
    return (
        accounts.filter(~is_blank(F.col("oap_acct_nbr")) & (F.col("e_date") > F.lit(start)))
        .join(owners, "oap_acct_nbr", "left_semi")
        .select(F.lit(ACCOUNT).alias("prmt_type"), F.col("sec_acct").alias("prmt_val"))
        .distinct()
    )


def batch_accounts(investors: DataFrame) -> DataFrame:
    """The accounts of a run: rows of type 2 only."""
    return investors.filter(F.col("prmt_type") == ACCOUNT).select(F.col("prmt_val").alias("sec_acct"))
