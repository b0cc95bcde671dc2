"""Size checks that decide how a lookup side is joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a narrow key table (a few short columns) that one executor holds without strain:
# about 100 MB as a hash relation.
BROADCAST_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Count `df` on the executors and compare with the bound."""
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint when its counted size is within the bound.

    Beyond the bound Spark shuffles both sides and splits hot keys at run time (adaptive skew
    join). It then hashes `df`, which has few rows per key, in each task and sorts neither side: the
    memory of a task does not grow with the rows that meet the lookup. Use it on stored tables or
    on narrow filtered scans, where counting is cheap.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df.hint("shuffle_hash")


# Shuffled bytes of one task. The compressed bytes of a stage of sums and joins take about thirty
# times as much memory in its hash tables and sorts.
TASK_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_FIRST_SPLIT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_HASHED_SIDE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def bound_tasks(spark: SparkSession) -> None:
    """Lower what Spark merges into one task after a shuffle, for the session; never raise it.

    Results are lazy, so the bound must hold when they are read.
    """
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if to_bytes(spark.conf.get(_ADVISORY)) > TASK_BYTES:
        spark.conf.set(_ADVISORY, f"{TASK_BYTES}b")


def shuffle_less(spark: SparkSession) -> None:
    """Settings of a run over very many instruments, for the session.

    Joins take rows as they are dealt already, also by some of the keys only: rows dealt by security
    meet quotes of (security, day) where they are. A join with a side of at most `TASK_BYTES` a task
    hashes that side and sorts neither.
    """
    spark.conf.set(_ALL_KEYS, "false")
    spark.conf.set(_HASHED_SIDE, f"{TASK_BYTES}b")


# Instruments whose rows make up one task of a shuffle, before small tasks are merged.
INSTRUMENTS_A_TASK = 5_000


def split_shuffles(spark: SparkSession, instruments: int) -> None:
    """Split shuffles by the number of instruments, for the session; never into fewer parts.

    Spark merges small parts up to the bytes of a task, but does not cut large ones, so a fixed
    number of parts would let a task grow with the market.
    """
    parts = -(-instruments // INSTRUMENTS_A_TASK)
    now = spark.conf.get(_FIRST_SPLIT, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if parts > int(now):
        spark.conf.set(_FIRST_SPLIT, str(parts))
