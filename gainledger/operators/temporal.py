"""Operators over versioned history tables and the trading calendar.

History rows are valid on [s_date, e_date): the start counts, the end does not.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import value_or_fail

OPEN_END = date(3000, 12, 31)


def valid_on(day: Column | date, start: str = "s_date", end: str = "e_date") -> Column:
    """True for history rows in force on `day`."""
    day = F.lit(day) if isinstance(day, date) else day
    return (F.col(start) <= day) & (F.col(end) > day)


def without_covered(
    facts: DataFrame, spells: DataFrame, key: str, day: str
) -> DataFrame:
    """Facts that no spell covers: same `key`, `day` inside [s_date, e_date).

    An anti join on the key with the range as a residual condition, so it stays a hash or
    sort-merge join.
    """
    spells = spells.select(
        F.col(key).alias("_key"), F.col("s_date").alias("_from"), F.col("e_date").alias("_to")
    )
    covered = (
        (F.col(key) == F.col("_key")) & (F.col("_from") <= F.col(day)) & (F.col("_to") > F.col(day))
    )
    return facts.join(spells, covered, "left_anti")


def latest_version(history: DataFrame, key: str, alive_after: date, keep: list[str]) -> DataFrame:
    """One row per key: the version with the latest start among those ending after a date.

    Struct maxima instead of a window: they combine on the map side, so a key with very many
    versions never lands whole in one task. Versions tied on the latest start must agree: the
    largest and the smallest hash of their values are compared, and a difference fails the query.
    """
    look = F.xxhash64(*keep)
    found = (
        history.filter(F.col("e_date") > F.lit(alive_after))
        .groupBy(key)
        .agg(
            F.max(F.struct("s_date", *keep)).alias("_v"),
            F.max(F.struct("s_date", look.alias("look"))).alias("_high"),
            F.max(F.struct("s_date", F.bitwise_not(look).alias("look"))).alias("_low"),
        )
    )
    agree = F.col("_high.look") == F.bitwise_not("_low.look")
    message = F.concat(F.lit(f"versions tied on their start: {key} "), F.coalesce(key, F.lit("null")))
    columns = [F.col(f"_v.{c}") for c in keep]
    columns = [value_or_fail(agree, columns[0], message), *columns[1:]]
    return found.select(key, *[c.alias(name) for c, name in zip(columns, keep, strict=True)])


def open_days(calendar: DataFrame) -> DataFrame:
    """Trading days; the flag may be stored as text or as a number."""
    return calendar.filter(F.col("is_trd_dt").cast("string") == "1").select("calendar_date")


def previous_open_day(dates: DataFrame, calendar: DataFrame, day: str, since: date) -> DataFrame:
    """(day, prev_open): the last trading day strictly before each date, if at or after `since`.

    Works on distinct calendar days only, so the ordered pass sees at most one row per day of
    history plus one per trading day, whatever the size of the facts. The answer joins back
    by equality; no range join is needed.
    """
    asked = dates.select(F.col(day).alias("d")).filter(F.col("d") > F.lit(since)).distinct()
    opened = open_days(calendar).filter(F.col("calendar_date") >= F.lit(since)).distinct()
    both = asked.select("d", F.lit(None).cast("date").alias("opened")).unionByName(
        opened.select(F.col("calendar_date").alias("d"), F.col("calendar_date").alias("opened"))
    )
    per_day = both.groupBy("d").agg(F.max("opened").alias("opened"))
    before = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    return per_day.select(F.col("d").alias(day), F.max("opened").over(before).alias("prev_open")).filter(
        F.col("prev_open").isNotNull()
    )


def last_open_day_to(calendar: DataFrame, limit: Column) -> Column:
    """Scalar subquery: the last trading day at or before `limit`."""
    return (
        open_days(calendar)
        .filter(F.col("calendar_date") <= limit)
        .agg(F.max("calendar_date"))
        .scalar()
    )


def held_on(holdings: DataFrame, asks: DataFrame) -> DataFrame:
    """Volume held per account and security on each asked day, summed over custody units.

    `asks` is (exch, sec_cde, ask_date) without duplicates; what else its rows say is kept. The
    holdings meet the asks before they are shuffled; only one partial sum per account, security and
    asked day is exchanged.
    """
    said = [c for c in asks.columns if c not in ("exch", "sec_cde", "ask_date")]
    match = (
        (F.col("mkt_sort") == F.col("exch"))
        & (F.col("h_sec") == F.col("sec_cde"))
        & valid_on(F.col("ask_date"))
    )
    return (
        holdings.withColumnRenamed("sec_cde", "h_sec")
        .join(asks, match)
        .groupBy(F.col("exch"), F.col("sec_acct_nbr").alias("sec_acct"), "sec_cde", "ask_date", *said)
        .agg(F.coalesce(F.sum("td_end_hold_vol"), F.lit(0)).alias("hold_vol"))
    )
