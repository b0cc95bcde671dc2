"""What all flow rules share: the scope of a run, its inputs and the ledger row."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import LEDGER_AMOUNT, LEDGER_TAX, LEDGER_VOLUME, security_code
from ..operators.sizing import broadcast_if_small
from ..operators.store import Workspace
from ..operators.temporal import held_on
from ..sources.parquet_tables import FROM_YEAR, MONTH, TO_MONTH, month_of

EXCHANGE_0 = "0"
EXCHANGE_1 = "1"

# Marks of stored holdings: the day was asked for by a rule's event, or is an end of the quoted period.
AT_EVENT, AT_BOUND = "at_event", "at_bound"

LEDGER_COLUMNS = [
    "exch", "sec_acct", "sec_cde", "biz_type", "tax_fee",
    "buy_vol", "sal_vol", "buy_amt", "sal_amt", "batch",
]


class Tables(Protocol):
    """Anything that gives the source tables by name."""

    cutover: str

    def table(self, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class Scope:
    """Period, accounts and instruments of one run."""

    batch: str
    start: date
    end: date
    accounts: DataFrame  # sec_acct, one row each
    instruments: DataFrame  # exch, sec_cde, one row each
    by_security: bool = False  # too many instruments to broadcast: they are met by shuffles

    def deal(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows dealt by security where the instruments are too many to broadcast.

        Joins on the security and any other key, and sums by account and security, then follow
        without another shuffle. With few instruments rows stay as they are.
        """
        return df.repartition(*(keys or ("sec_cde",))) if self.by_security else df

    def in_period(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))

    def keep_accounts(self, df: DataFrame) -> DataFrame:
        """Rows of the run's accounts.

        Applied after a rule has summed up by account: Catalyst moves the semi join below the
        sum when the accounts fit a broadcast. When they do not, the join meets one row per
        account and security instead of raw rows, so a very active account is no hot key.
        """
        return df.join(self.accounts, "sec_acct", "left_semi")

    def keep_securities(self, df: DataFrame, exch: str) -> DataFrame:
        """Rows of the run's instruments on one exchange; placed like `keep_accounts`."""
        return df.join(self.securities(exch), "sec_cde", "left_semi")

    def keep(self, df: DataFrame, exch: str) -> DataFrame:
        return self.keep_accounts(self.keep_securities(df, exch))

    def securities(self, exch: str) -> DataFrame:
        return self.instruments.filter(F.col("exch") == exch).select("sec_cde")


@dataclass(frozen=True)
class Inputs:
    """Source tables of one run plus the sets several rules share.

    `shared` holds stored versions of those sets during a batch run, so that the large tables
    behind them are read once; without them each rule computes just what it needs.
    """

    tables: Tables
    scope: Scope
    shared: Mapping[str, DataFrame] = field(default_factory=dict)
    work: Workspace | None = None

    def table(self, name: str) -> DataFrame:
        return self.tables.table(name)

    def between(self, name: str, day: str, first: Column, last: Column) -> DataFrame:
        """Rows of a table whose `day` lies in a range of days.

        Stored tables are laid out by month; the range then also selects the month folders, so a
        short period neither lists nor opens the files of the whole history.
        """
        rows = period_rows(self.table(name), day, first, last)
        return rows.drop(MONTH)

    def in_period(self, name: str, day: str) -> DataFrame:
        return self.between(name, day, F.lit(self.scope.start), F.lit(self.scope.end))

    def common(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.shared[name] if name in self.shared else make()

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A small set written out before its size is asked for, so that it is computed once."""
        work = self.work or Workspace(df.sparkSession, tidy=True)
        return work.store(df, f"{name}_{uuid.uuid4().hex[:8]}")

    def quotes(self) -> DataFrame:
        """Closes of the run's instruments in the period: exch, sec_cde, day, cls_prc."""
        return self.common("quotes", lambda: period_quotes(self.tables, self.scope))

    def close_on(self, exch: str) -> DataFrame:
        """Closes of one exchange; rules of a run that join them share one shuffle of them."""
        quotes = self.quotes().filter((F.col("exch") == exch) & self.scope.in_period("day"))
        return self.scope.deal(quotes.select("sec_cde", "day", "cls_prc"))

    def held_on(self, asks: DataFrame) -> DataFrame:
        """Holdings of the run's accounts: (exch, sec_acct, sec_cde, ask_date) -> hold_vol.

        A stored set may answer more days than asked; callers join it back to their events.
        """
        return self.common(
            "held", lambda: scope_holdings(self.tables, self.scope, self.stored(asks.distinct(), "asks"))
        )

    def held(self, exch: str, events: DataFrame) -> DataFrame:
        """The same for the (sec_cde, ask_date) of `events` in the period, on one exchange.

        Rules of a run that join them share one shuffle of them.
        """
        asks = events.select(F.lit(exch).alias("exch"), "sec_cde", "ask_date")
        rows = marked(self.held_on(asks), AT_EVENT)
        rows = rows.filter((F.col("exch") == exch) & self.scope.in_period("ask_date"))
        return self.scope.deal(rows.drop("exch"))


def marked(held: DataFrame, mark: str) -> DataFrame:
    """The stored holdings with a mark; all where there are no marks."""
    return held.filter(mark).drop(AT_EVENT, AT_BOUND) if mark in held.columns else held


def period_rows(rows: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Rows with `day` from `first` to `last`, by month folder where there are any."""
    rows = rows.filter((F.col(day) >= first) & (F.col(day) <= last))
    if MONTH in rows.columns:
        rows = rows.filter((F.col(MONTH) >= month_of(first)) & (F.col(MONTH) <= month_of(last)))
    return rows


def rows_in_force(rows: DataFrame, first: Column, last: Column, on_end: bool = False) -> DataFrame:
    """Rows valid on any day from `first` to `last`, by folder of both ends where there are any.

    The end of a row does not count as a day of it, but for `on_end`.
    """
    ended = F.col("e_date") >= first if on_end else F.col("e_date") > first
    rows = rows.filter((F.col("s_date") <= last) & ended)
    if TO_MONTH in rows.columns:
        rows = rows.filter((F.col(TO_MONTH) >= month_of(first)) & (F.col(FROM_YEAR) <= F.year(last)))
        rows = rows.drop(TO_MONTH, FROM_YEAR)
    return rows


def period_quotes(tables: Tables, scope: Scope) -> DataFrame:
    quotes = (
        period_rows(tables.table("sec_quot"), "trad_date", F.lit(scope.start), F.lit(scope.end))
        .select(F.col("sec_exch_cde").alias("exch"), "sec_cde", F.col("trad_date").alias("day"), "cls_prc")
    )
    return quotes.join(scope.instruments, ["exch", "sec_cde"], "left_semi")


def scope_holdings(tables: Tables, scope: Scope, asks: DataFrame) -> DataFrame:
    """(exch, sec_acct, sec_cde, ask_date) -> hold_vol for the accounts of the run.

    The asks are a few days per security, stored and without duplicates. They are counted and
    broadcast within the bound, so the holdings are filtered where they are read and never
    shuffled row by row.
    """
    wanted = broadcast_if_small(asks)
    return scope.keep_accounts(held_on(holdings_in_period(tables, scope), wanted))


def holdings_in_period(tables: Tables, scope: Scope) -> DataFrame:
    return rows_in_force(tables.table("hold_his"), F.lit(scope.start), F.lit(scope.end)).select(
        "mkt_sort", "sec_acct_nbr", "sec_cde", "td_end_hold_vol", "s_date", "e_date"
    )


def ledger_rows(
    flows: DataFrame,
    exch: str,
    biz_type: str,
    batch: str,
    *,
    tax: str | None = None,
    buy_vol: str | None = None,
    sal_vol: str | None = None,
    buy_amt: str | None = None,
    sal_amt: str | None = None,
) -> DataFrame:
    """Ledger rows from per-account, per-security sums; a measure not named is zero."""

    def measure(name: str | None, kind) -> Column:
        value = F.lit(0) if name is None else F.coalesce(F.col(name), F.lit(0))
        return value.cast(kind)

    return flows.select(
        F.lit(exch).alias("exch"),
        "sec_acct",
        "sec_cde",
        F.lit(biz_type).alias("biz_type"),
        measure(tax, LEDGER_TAX).alias("tax_fee"),
        measure(buy_vol, LEDGER_VOLUME).alias("buy_vol"),
        measure(sal_vol, LEDGER_VOLUME).alias("sal_vol"),
        measure(buy_amt, LEDGER_AMOUNT).alias("buy_amt"),
        measure(sal_amt, LEDGER_AMOUNT).alias("sal_amt"),
        F.lit(batch).alias("batch"),
    )


def totals(daily: DataFrame, **sums: Column | str) -> DataFrame:
    """Sums by account and security."""
    return daily.groupBy("sec_acct", "sec_cde").agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )


def with_code(df: DataFrame, column: str = "sec_cde") -> DataFrame:
    return df.withColumn("sec_cde", security_code(F.col(column)))


def price_sums(prices: DataFrame, keys: list[str], price: str) -> DataFrame:
    """One row per key: how many price rows match it and the sum of their prices.

    A join to several price rows counts a volume once per row. With the rows summed up
    beforehand, volume x n and volume x sum give the same totals and the join stays one to one.
    """
    return prices.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_prices"), F.sum(price).alias("sum_price")
    )
