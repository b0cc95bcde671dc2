"""What several operators share: reading tables, bounded broadcasts, word and letter classes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.store import Workspace

# Fixed values of the contracts.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of a narrow lookup side that may be broadcast once they are counted: some 30 MB.
LOOKUP_ROWS = 200_000
# Rows of text in an Arrow batch.
TEXTS_PER_BATCH = 2_000
# Rows of one file that a row number has room for.
ROWS_PER_FILE = 1 << 36
# Narrow rows that a task takes at least in steps over tables whose size is known.
ROWS_PER_TASK = 20_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lookup(df: DataFrame) -> DataFrame:
    """A stored lookup side: broadcast when its counted rows are within the bound, else shuffled."""
    return broadcast_if_small(df, LOOKUP_ROWS)


def text_of(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, work: Workspace, name: str) -> DataFrame:
    """`docs` with a number for each row in the new column `name`, the same whenever it is read.

    Rows of `docs` as read from files (at most filtered) are named by their file and their place in
    it, so nothing is copied: only the list of files is stored, and numbered in its own order. Rows
    of any other table have no such place; that table is stored once with its numbers.
    """
    try:
        place = docs.metadataColumn("_metadata")
        file, at = place.getField("file_path"), place.getField("row_index")
        files = docs.select(file.alias("file")).distinct()
    except AnalysisException:
        return work.store(docs.withColumn(name, F.monotonically_increasing_id()), f"{name}_input")
    files = files.coalesce(1).sortWithinPartitions("file").withColumn("nth", F.monotonically_increasing_id())
    path, nth = free_name(docs, f"{name}_path"), free_name(docs, f"{name}_nth")
    known = broadcast_if_small(work.store(files.select(F.col("file").alias(path), F.col("nth").alias(nth)), f"{name}_files"))
    here, row = free_name(docs, f"{name}_here"), F.col(nth) * ROWS_PER_FILE
    located = docs.withColumns({here: file, name: at}).join(known, F.col(here) == F.col(path))
    return located.withColumn(name, row + F.col(name)).select(*[f"`{c}`" for c in docs.columns], name)


def to_python(rows: DataFrame) -> DataFrame:
    """`rows`, to be handed to Python in batches of bounded size: rows of text are long.

    Lowers the session's bound on rows per Arrow batch, on which the memory of a task depends on
    both sides.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXTS_PER_BATCH:
        conf.set(name, str(TEXTS_PER_BATCH))
    return rows


def tasks_for(rows: int) -> int:
    """Tasks for a step over so many narrow rows, so that small tables aren't dealt out to many."""
    return max(1, -(-rows // ROWS_PER_TASK))
