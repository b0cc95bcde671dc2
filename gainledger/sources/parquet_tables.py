"""Source tables stored as Parquet, one folder per table, and their ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import right_trimmed
from .schemas import BUSINESS_DATE, SOURCES

MONTH = "data_month"  # year x 100 + month of the business date
BY_VALIDITY = {"hold_his"}  # rows in force over a period, not on a day
BY_MONTH = set(BUSINESS_DATE) - BY_VALIDITY
FROM_YEAR, TO_MONTH = "from_year", "to_month"  # of the first day in force and of the day it ends
DEFAULT_CUTOVER = "2017-05-01"  # first day of the new generation of exchange-1 changes


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def folders_of(name: str) -> list[str]:
    """The columns that a source table has folders for."""
    return [MONTH] if name in BY_MONTH else [TO_MONTH, FROM_YEAR] if name in BY_VALIDITY else []


class ParquetTables:
    """Tables read by name with their declared schema; nothing is inferred."""

    def __init__(self, spark: SparkSession, root: str, cutover: str = DEFAULT_CUTOVER):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cutover = cutover

    def table(self, name: str) -> DataFrame:
        """A table as declared, and the columns it is laid out by: month, or year and month in force."""
        fields = list(SOURCES[name].fields)
        fields += [T.StructField(folder, T.IntegerType()) for folder in folders_of(name)]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.root}/{name}")


def normalised(raw: DataFrame, name: str) -> DataFrame:
    """A raw extract with the declared columns and types and without trailing blanks."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCES[name].fields]
    return right_trimmed(raw.select(*columns))


def ingest(raw: DataFrame, root: str, name: str) -> None:
    """Write one source table in the layout the rules read best.

    Dated rows get a folder for each month. They are rebalanced by month first, so that a month
    has few files and a very busy one is still written by many tasks, and sorted by day inside
    each task, so that the statistics of the row groups skip other days.

    Holdings are in force over periods. They get a folder for the month they end in (rows still in
    force share that of the open end) and below it for the year they begin in: a period then leaves
    out all that ended before it and all that began after its last year. Months on both sides would
    square the number of folders; within a year, rows are sorted by their first day instead.
    """
    table = normalised(raw, name)
    day, folders = BUSINESS_DATE.get(name), folders_of(name)
    if name in BY_MONTH:
        table = table.withColumn(MONTH, month_of(F.col(day)))
    elif name in BY_VALIDITY:
        table = table.withColumns({TO_MONTH: month_of(F.col("e_date")), FROM_YEAR: F.year(day)})
    if folders:
        table = table.hint("rebalance", *folders)
    if day:
        table = table.sortWithinPartitions(*folders, day)
    writer = table.write.mode("overwrite")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.parquet(f"{root.rstrip('/')}/{name}")
