"""Shards of near equal bytes by sampled splitters and range partitioning.

Only DataFrame functions. Records are ordered by a key that begins with the hash of their text, so
equal texts stand together; the rest of the key makes it unique, so that any range, also one inside
a large group of equal texts, can be split further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import text_of

# Bytes a record takes besides its text.
OVERHEAD = 16
# Ranges for each shard at least, rows a range should hold at most, and the most ranges at first.
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 50_000
MOST_RANGES = 4_000
# Sampled keys for each range, and rounds of splitting ranges that came out too full.
SAMPLES_PER_RANGE = 32
SPLIT_ROUNDS = 3
# A range is overfull when it holds so many times the bytes meant for it, its largest record aside.
OVERFULL = 2


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 16, "0")


def sized_records(docs: DataFrame, work: Workspace, id: str, text: str) -> DataFrame:
    """A stored narrow table: id, size, crc, key (unique, led by the hash of the text)."""
    body = text_of(text)
    rows = docs.select(
        F.col(id).alias("id"),
        (F.octet_length(body).cast("long") + OVERHEAD).alias("size"),
        F.crc32(body).alias("crc"),
        F.concat(
            _hex(F.xxhash64(body)), _hex(F.xxhash64(F.col(id))), _hex(F.monotonically_increasing_id())
        ).alias("key"),
    )
    return work.store(rows, "shard_records")


def sampled_splitters(records: DataFrame, total: int, pieces: int, samples: int) -> list[str]:
    """Keys that cut `records` of `total` bytes into about `pieces` ranges of equal bytes.

    A record is drawn with a chance in proportion to its size, and counts for the bytes it stands
    for. The sample is bounded by `pieces` x `samples` (and the records larger than one share).
    """
    share = total / (pieces * samples)
    luck = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = records.filter(luck < F.col("size") / F.lit(share)).select(
        "key", F.greatest(F.col("size"), F.lit(share)).alias("weight")
    )
    upto = F.sum("weight").over(W.orderBy("key").rowsBetween(W.unboundedPreceding, 0))
    whole = F.sum("weight").over(W.partitionBy())
    cuts = (
        drawn.withColumn("piece", F.floor((upto - F.col("weight")) * pieces / whole))
        .groupBy("piece")
        .agg(F.min("key").alias("key"))
        .filter("piece > 0")
    )
    return sorted(r.key for r in cuts.collect())


def with_range(records: DataFrame, splitters: list[str]) -> DataFrame:
    """Adds `range`: how many splitters are at or below the key, by binary search in a literal."""
    step = 1
    while step <= len(splitters):
        step *= 2
    # Filled up with a key above all hexadecimal ones.
    filled = splitters + ["g"] * (step - 1 - len(splitters))
    found = records.withColumn("range", F.lit(0))
    while step > 1:
        step //= 2
        key = F.element_at(F.split(F.lit(",".join(filled)), ","), F.col("range") + step)
        found = found.withColumn("range", F.col("range") + F.when(key <= F.col("key"), step).otherwise(0))
    return found


def shard_by_bytes(
    docs: DataFrame, work: Workspace, shards: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: id, size, crc, shard (0 to shards - 1), slot (gapless from 0).

    Shards are runs of the key order; a record belongs to the shard in which the middle of its bytes
    falls, so the bytes of two shards differ by less than two of their largest records. Null text
    has no bytes (size is the overhead, crc 0); null and repeated ids and rows are placed like any
    other; with fewer rows than shards some shards stay empty; an empty table gives no rows.
    """
    work = work.inner()
    records = sized_records(docs, work, id, text)
    whole = records.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    total, ranges = whole.bytes, max(RANGES_PER_SHARD * shards, min(MOST_RANGES, whole.rows // ROWS_PER_RANGE))

    splitters = sampled_splitters(records, max(1, total), ranges, SAMPLES_PER_RANGE)
    for _ in range(SPLIT_ROUNDS):
        ranged = with_range(records, splitters)
        filled = work.store(
            ranged.groupBy("range").agg(
                F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("largest")
            ),
            f"shard_ranges_{len(splitters)}",
        )
        over = filled.filter(F.col("bytes") - F.col("largest") > OVERFULL * total / ranges).collect()
        if not over:
            break
        inside = ranged.filter(F.col("range").isin([r.range for r in over]))
        bytes_over = sum(r.bytes for r in over)
        pieces = max(2 * len(over), -(-bytes_over * ranges // total))
        more = sampled_splitters(inside, bytes_over, pieces, SAMPLES_PER_RANGE)
        if set(more) <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    ranged = with_range(records, splitters)

    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("range")
        .agg(F.count("*").alias("n"), F.sum("size").alias("b"))
        .select(
            "range",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
        )
    )
    within = W.partitionBy("range").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    placed = (
        ranged.select(
            "id",
            "size",
            "crc",
            "range",
            F.sum("size").over(within).alias("upto"),
            F.count("*").over(within).alias("nth"),
        )
        .join(F.broadcast(starts), "range")  # as many rows as there are ranges
        .select(
            "id",
            "size",
            "crc",
            (F.col("rows_before") + F.col("nth") - 1).alias("rank"),
            F.least(
                F.lit(shards - 1),
                F.floor((2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")) * shards / (2 * max(1, total))),
            )
            .cast("int")
            .alias("shard"),
        )
    )
    placed = work.store(placed, "shard_placed")
    work.remove(keep=["shard_placed"])
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # one row per shard
        "id", "size", "crc", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
