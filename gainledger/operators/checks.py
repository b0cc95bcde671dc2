"""Key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A table that must have one row per key has more."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def value_or_fail(ok: Column, value: Column, message: Column) -> Column:
    """`value` where `ok` holds; anywhere else the query that reads it fails with the message.

    The check is part of the plan, so it costs no pass of its own and no row can slip by it.
    """
    return F.when(ok, value).otherwise(F.raise_error(message))


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """`df` itself, after checking that no key repeats."""
    first = duplicate_keys(df, keys).take(1)
    if first:
        raise DuplicateKeyError(f"{what}: {keys} repeats, e.g. {first[0].asDict()}")
    return df
