"""Column expressions used across the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_TAX = T.DecimalType(18, 3)
LEDGER_VOLUME = T.DecimalType(18, 0)
LEDGER_AMOUNT = T.DecimalType(18, 2)


def security_code(code: Column) -> Column:
    """Six-character security code of an integer or text code, zero-filled on the left.

    Longer codes are kept as they are: cutting them would merge two securities.
    """
    text = F.trim(code.cast("string"))
    return F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0"))


def right_trimmed(df: DataFrame) -> DataFrame:
    """All text columns without trailing blanks.

    Fixed-width text is compared blank-padded in the source system. Trimming belongs to
    ingest: a trimmed stored column still takes part in Parquet filter pushdown, whereas
    `rtrim(col) = 'x'` in every rule would not.
    """
    return df.select(
        *[
            F.rtrim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col) == "")


def sum_when(condition: Column, value: Column) -> Column:
    """Conditional sum; rows outside the condition add zero."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def positive_part(col: Column) -> Column:
    return F.greatest(col, F.lit(0))


def negative_part(col: Column) -> Column:
    return F.greatest(-col, F.lit(0))
