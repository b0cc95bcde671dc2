"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. Every step groups with partial sums, so a group of copies that holds a
third of all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import fits_broadcast
from ..operators.store import Workspace
from .common import LOOKUP_ROWS, SPACES, free_name, lookup, numbered, text_of

# Characters of the normalised text that the second step hashes.
PREFIX_CHARS = 64


def normalised(text: str) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(text_of(text), SPACES, "")


def exact_copies(
    docs: DataFrame,
    work: Workspace,
    carry: Mapping[str, Column],
    id: str = "doc_id",
    text: str = "text",
    row: Column | None = None,
) -> DataFrame:
    """One row per input row: the carried columns, keep_id, group_size, kept.

    Texts are equal when they are identical after deleting white space. Of equal texts the row with
    the most code points in the original text stays, then the smallest id (a null id comes last).
    Rows repeated with the same id and text are one group of which exactly one row is kept; null,
    empty and blank texts are equal to each other. An empty table gives no rows. `carry` names the
    output columns and how they are computed from `docs`; it may not use the names added here or
    names that begin with an underscore. `row` is a number of each row, where there is one already:
    of rows equal in text and id the first by it stays.

    1. Rows are counted by the length and a prefix hash of their normalised text (narrow table).
    2. Lengths met once are dropped, then (length, prefix hash) met once.
    3. The full text of the rows left is hashed, and rows are grouped by that hash. The suspects
       are sent to the texts as a broadcast while they fit; beyond that, moving texts to them would
       cost more than hashing every text where it is read, which is what happens then.
    """
    work = work.inner()
    norm = normalised(text)
    size = F.octet_length(norm)
    prefix = F.xxhash64(F.substring(norm, 1, PREFIX_CHARS))

    marks = docs.select(size.alias("size"), prefix.alias("prefix"))
    marks = work.store(marks.groupBy("size", "prefix").agg(F.count("*").alias("n")), "exact_marks")
    crowded = marks.groupBy("size").agg(F.sum("n").alias("n")).filter("n > 1").select("size")
    suspects = (
        marks.join(crowded, "size", "left_semi")
        .filter("n > 1")
        .select(F.col("size").alias("_s"), F.col("prefix").alias("_p"), F.lit(True).alias("_suspect"))
    )
    suspects = work.store(suspects, "exact_suspects")

    rows = docs.select(
        *[how.alias(name) for name, how in carry.items()],
        F.col(id).alias("_id"),
        F.length(text_of(text)).alias("_chars"),
        size.alias("_size"),
        prefix.alias("_prefix"),
        norm.alias("_norm"),
        (F.monotonically_increasing_id() if row is None else row).alias("_row"),
    )
    if fits_broadcast(suspects, LOOKUP_ROWS):
        known = (F.col("_size") == F.col("_s")) & (F.col("_prefix") == F.col("_p"))
        rows = rows.join(F.broadcast(suspects), known, "left")
    else:
        rows = rows.withColumn("_suspect", F.lit(True))
    refined = work.store(
        rows.select(
            *carry,
            "_id",
            "_chars",
            F.when(F.col("_suspect"), F.sha2(F.col("_norm"), 256)).alias("_hash"),
            "_row",
        ),
        "exact_refined",
    )

    best = F.max(F.struct("_chars", (-F.col("_id")).alias("less"), (-F.col("_row")).alias("row")))
    groups = (
        refined.filter(F.col("_hash").isNotNull())
        .groupBy("_hash")
        .agg(F.count("*").alias("_n"), best.alias("_best"))
        .filter("_n > 1")
        .select(
            F.col("_hash").alias("_key"),
            "_n",
            (-F.col("_best.less")).alias("_keep"),
            (-F.col("_best.row")).alias("_keep_row"),
        )
    )
    groups = lookup(work.store(groups, "exact_groups"))
    work.remove(keep=["exact_refined", "exact_groups"])
    # Rows that stand alone get a key of their own, so that they do not meet in one task.
    key = F.coalesce("_hash", F.col("_row").cast("string"))
    grouped = F.col("_n").isNotNull()
    return refined.join(groups, key == F.col("_key"), "left").select(
        *carry,
        F.when(grouped, F.col("_keep")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).alias("group_size"),
        F.when(grouped, F.col("_row") == F.col("_keep_row")).otherwise(F.lit(True)).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, work: Workspace, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their own columns only.

    Texts are neither copied nor moved: rows are told apart by a number, and the numbers of those
    that go are counted and sent to the texts. `docs` is as read from files, or else copied once.
    """
    work = work.inner()
    row, name = free_name(docs, "row_number"), free_name(docs, "gone")
    rows = numbered(docs, work, row)
    gone = exact_copies(rows, work, {"c": F.col(row)}, id, text, F.col(row)).filter(~F.col("kept"))
    gone = lookup(work.store(gone.select(F.col("c").alias(name)), "exact_gone"))
    work.remove(keep=[f"{row}_input", f"{row}_files", "exact_gone"])
    return rows.join(gone, F.col(row) == F.col(name), "left_anti").select(*[f"`{c}`" for c in docs.columns])
