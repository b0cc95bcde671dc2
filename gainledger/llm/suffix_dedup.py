"""Removal of byte strings that repeat across documents, by column-wise construction of collections.

A string of LENGTH bytes shared by two texts holds an anchor in both (see repeat_anchors), so it is
enough to compare the surroundings of equal anchors. The surroundings of one anchor are a collection
of short strings; its Burrows-Wheeler transform and common prefixes are built column by column, one
symbol of every string each round, which finds all equal strings of LENGTH bytes and the smallest
document of each. What goes from step to step is written and read sequentially: tables in the shared
folder and shuffles, never a structure over the whole corpus.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import lookup, to_python
from .repeat_anchors import LENGTH, REACH, anchors, begins_of, column_wise, contexts, covered

# Bytes of text that a task handles at once, and that share one bucket of anchor hashes.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 64 << 20
LEAST_BUCKETS = 16
# Surroundings compared at once, and of one anchor at most; beyond that its strings are compared by
# a grouping that has no large groups.
TOGETHER = 30_000
MOST_OF_ANCHOR = 400_000
# Hexadecimal digits of a text's hash that make its number.
NUMBER_DIGITS = 15
# The order of documents without an id.
LAST = (1 << 63) - 1

LOW = np.uint64(0xFFFFFFFF)


def _chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches with about `most` bytes of text each, whatever size they arrive in."""
    held, size = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            held.append(part)
            size += sum(len(x.as_buffer() or b"") for x in part.column(column) if x.is_valid)
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _bytes_of(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _runs(values: np.ndarray) -> np.ndarray:
    """Begins of the runs of equal values, with the end."""
    return np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values)) if len(values) else np.zeros(1, np.int64)


def _lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values, kind))


def numbered(rows: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """`rows` (id, ord, hex, text) with a number for each different text, and the stored narrow
    rows (id, ord, num, name, n_bytes).

    The number is a part of the text's hash, `name` another one. Where two texts get one number,
    which is found out over all rows, those texts are numbered by another part of the hash.
    """
    first = F.conv(F.substring("hex", 1, NUMBER_DIGITS), 16, 10).cast("long")
    other = -F.conv(F.substring("hex", 49, 15), 16, 10).cast("long") - 1
    rows = rows.withColumns({"num": first, "name": F.unhex(F.substring("hex", 17, 32))})
    narrow = ["id", "ord", "num", "name", F.octet_length("text").cast("long").alias("n_bytes")]
    listed = work.store(rows.select(*narrow), "repeat_rows")
    shared = listed.groupBy("num").agg((F.min("name") != F.max("name")).alias("clash")).filter("clash")
    shared = work.store(shared.select(F.col("num").alias("c_num"), "clash"), "repeat_clashes")
    if shared.take(1):
        rows = rows.join(lookup(shared), F.col("num") == F.col("c_num"), "left")
        rows = rows.withColumn("num", F.when(F.col("clash"), other).otherwise(F.col("num"))).drop("c_num", "clash")
        listed = work.store(rows.select(*narrow), "repeat_renumbered")
    return rows.drop("hex"), listed


def distinct_texts(rows: DataFrame, work: Workspace) -> tuple[str, DataFrame]:
    """The table (num, ord, text) of the different texts, with the smallest order of each.

    Stored in buckets of the number, so that what later steps find out about texts comes to the texts
    without moving them again. The sum by number deals the rows out as the buckets do, so that every
    bucket is one file.
    """
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.groupBy("num").agg(F.min("ord").alias("ord"), F.any_value("text").alias("text"))
    table = f"distinct_texts_{uuid.uuid4().hex}"
    (
        texts.write.option("path", f"{work.root}/{table}")
        .option("compression", "zstd")
        .bucketBy(buckets, "num")
        .sortBy("num")
        .saveAsTable(table)
    )
    return table, spark.table(table)


def _anchor_rows(buckets: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchor hashes of texts, by bucket; hashes met in two texts of a chunk are known to repeat,
        so one of their texts stands for all in the bucket, and all are told at once."""
        for batch in _chunks(batches, 1):
            nums = batch.column(0).to_numpy()
            hashed, text, _ = anchors(_bytes_of(batch.column(1)))
            order = np.argsort(hashed, kind="stable")
            hashed, text = hashed[order], text[order]
            edges = _runs(hashed)
            begin, end = edges[:-1], edges[1:]
            if not len(begin):
                continue
            out: list[list] = [[], [], [], [], []]  # bucket, num, nums, counts, keys
            several = text[begin] != text[end - 1]
            known = np.repeat(several, end - begin)
            pair = np.unique((text[known].astype(np.uint64) << np.uint64(32)) | (hashed[known] >> np.uint64(32)))
            whose, keys = (pair >> np.uint64(32)).astype(np.int64), (pair & LOW).astype("<u4")
            edges = _runs(whose)
            for a, b in zip(edges, edges[1:], strict=False):
                for column, value in zip(out, (None, int(nums[whose[a]]), None, None, keys[a:b].tobytes()), strict=True):
                    column.append(value)
            bucket = (hashed[begin] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((text[begin], bucket))
            bucket, whose, keys = bucket[order], text[begin][order], (hashed[begin][order] >> np.uint64(32)).astype("<u4")
            edges = _runs(bucket)
            for a, b in zip(edges, edges[1:], strict=False):
                inner = _runs(whose[a:b])
                values = (
                    int(bucket[a]),
                    None,
                    nums[whose[a:b][inner[:-1]]].tobytes(),
                    np.diff(inner).astype("<u4").tobytes(),
                    keys[a:b].tobytes(),
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["bucket", "num", "nums", "counts", "keys"])

    return read


def _repeated_in_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each text that other texts of the bucket have, too; rows come sorted by bucket."""

    def told(rows: list[tuple]) -> pa.RecordBatch | None:
        nums = np.frombuffer(b"".join(r[0] for r in rows), np.int64)
        counts = np.frombuffer(b"".join(r[1] for r in rows), "<u4").astype(np.int64)
        keys = np.frombuffer(b"".join(r[2] for r in rows), "<u4")
        order = np.argsort(keys, kind="stable")
        edges = _runs(keys[order])
        again = np.zeros(len(keys), bool)
        again[order] = np.repeat(np.diff(edges) > 1, np.diff(edges))
        if not again.any():
            return None
        whose = np.repeat(np.arange(len(counts)), counts)[again]
        edges = _runs(whose)
        found = keys[again]
        parts = [found[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(nums[whose[edges[:-1]]]), pa.array(parts, pa.binary())], ["num", "keys"])

    now, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now and held:
                if (rows := told(held)) is not None:
                    yield rows
                held = []
            now = bucket
            held.append(row)
    if held and (rows := told(held)) is not None:
        yield rows


# `range` holds the first and the last column in which a string may begin, as first x 64 + last.
CONTEXT = "key long, context binary, range int, ord long, num long, positions array<int>"
CONTEXT_NAMES = ["key", "context", "range", "ord", "num", "positions"]


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings of the anchors that repeat. Equal surroundings of one chunk are sent once, for
    their smallest document; in all others every string in them is a repeat, which is settled here
    (rows without context)."""
    spread = 0
    for batch in _chunks(batches, 2):
        nums, orders = batch.column(0), batch.column(1).to_numpy()
        texts = _bytes_of(batch.column(2))
        hashed, text, position = anchors(texts)
        wanted = [np.frombuffer(b"".join(keys), "<u4") for keys in batch.column(3).to_pylist()]
        owner = np.repeat(np.arange(len(wanted), dtype=np.uint64), [len(w) for w in wanted])
        chosen = np.isin(
            (text.astype(np.uint64) << np.uint64(32)) | (hashed >> np.uint64(32)),
            (owner << np.uint64(32)) | np.concatenate(wanted).astype(np.uint64),
        )
        hashed, text, position = hashed[chosen], text[chosen], position[chosen]
        if not len(text):
            continue
        matrix, first, last = contexts(texts, text, position)
        weights = np.random.default_rng(23).integers(1, 1 << 62, matrix.shape[1], np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        alike = np.zeros(len(text), np.uint64)
        for column in range(matrix.shape[1]):
            alike += matrix[:, column].astype(np.uint64) * weights[column]
        alike ^= alike >> np.uint64(31)
        alike = alike * np.uint64(0x9E3779B97F4A7C15) + hashed + (first * 64 + last).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.lexsort((position, text, orders[text], alike))
        alike, text, position, hashed, first, last = (x[order] for x in (alike, text, position, hashed, first, last))
        matrix = matrix[order]
        edges = _runs(alike)
        least = np.repeat(orders[text[edges[:-1]]], np.diff(edges))
        sent = orders[text] == least

        # One row for each surroundings and text, with all its places.
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        pair = _runs(group[sent] * len(texts) + text[sent])
        lead = np.flatnonzero(sent)[pair[:-1]]
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array(hashed[lead].view(np.int64)),
                pa.array([m.tobytes() for m in matrix[lead]], pa.binary()),
                pa.array((first * 64 + last)[lead].astype(np.int32)),
                pa.array(orders[text[lead]]),
                nums.take(pa.array(text[lead])),
                _lists(position[sent].astype(np.int32), pair, pa.int32()),
            ],
            CONTEXT_NAMES,
        )
        yield rows
        rest = np.flatnonzero(~sent)
        if len(rest):
            rest = rest[np.argsort(text[rest], kind="stable")]
            edges = _runs(text[rest])
            lead = rest[edges[:-1]]
            n = len(lead)
            spread += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashed[lead].view(np.int64) + spread),
                    pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.array(orders[text[lead]]),
                    nums.take(pa.array(text[lead])),
                    _lists(position[rest].astype(np.int32), edges, pa.int32()),
                ],
                CONTEXT_NAMES,
            )


FOUND = "num long, ord long, positions array<int>, mask long, string binary"


def _found(rows: pa.RecordBatch, mask: np.ndarray, strings: list[bytes] | None = None) -> pa.RecordBatch:
    """Context rows with the columns in which repeats begin, or with one string each."""
    string = pa.nulls(len(mask), pa.binary()) if strings is None else pa.array(strings, pa.binary())
    columns = [rows.column(4), rows.column(3), rows.column(5), pa.array(mask, pa.int64()), string]
    return pa.RecordBatch.from_arrays(columns, ["num", "ord", "positions", "mask", "string"])


def _as_matrix(contexts: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(contexts.to_pylist()), np.uint8).reshape(len(contexts), LENGTH + REACH)


def _compared(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Masks of whole collections; rows come sorted by key."""
    keys = rows.column(0).to_numpy()
    edges = _runs(keys)
    group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    span, order = rows.column(2).to_numpy(), rows.column(3).to_numpy()
    mask = column_wise(_as_matrix(rows.column(1)), group, span // 64, span % 64, order)
    return _found(rows.filter(pa.array(mask != 0)), mask[mask != 0])


def _strings(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Every string of LENGTH bytes by itself, with the places in which it begins."""
    matrix = _as_matrix(rows.column(1))
    span = rows.column(2).to_numpy()
    for column in range(REACH + 1):
        valid = (span // 64 <= column) & (column <= span % 64)
        strings = [m.tobytes() for m in matrix[valid, column : column + LENGTH]]
        mask = np.full(len(strings), np.int64(1) << np.int64(column))
        yield _found(rows.filter(pa.array(valid)), mask, strings)


def _repeats(most: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Collections are compared together up to TOGETHER rows; rows come sorted by key."""
        held: list[pa.RecordBatch] = []
        size, last_key, of_last, crowded = 0, None, 0, None
        for whole in batches:
            settled = pa.array(whole.column(1).is_null())
            done = whole.filter(settled)
            if done.num_rows:
                yield _found(done, np.full(done.num_rows, -1, np.int64))
            batch = whole.filter(pa.array(whole.column(1).is_valid()))
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            edges = _runs(keys)
            for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                key, part = int(keys[a]), batch.slice(a, b - a)
                if key == crowded:
                    yield from _strings(part)
                    continue
                if key != last_key:
                    if size >= TOGETHER:
                        yield _compared(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                        held, size = [], 0
                    last_key, of_last = key, 0
                held.append(part)
                size += b - a
                of_last += b - a
                if of_last > most:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    others = size - of_last
                    if others:
                        yield _compared(rows.slice(0, others).combine_chunks().to_batches()[0])
                    for piece in rows.slice(others).to_batches(max_chunksize=10_000):
                        yield from _strings(piece)
                    held, size, crowded = [], 0, key
        if held:
            yield _compared(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return read


RESULT = "num long, ord long, n_bytes long, begins array<int>, ends array<int>, kept binary"


def _removed(digest: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches, 2):
            begins, ends, kept, sizes = [], [], [], []
            for text, found in zip(_bytes_of(batch.column(2)), batch.column(3), strict=True):
                size = len(text)
                gone = np.zeros(size, bool)
                if found.is_valid:
                    rows = found.values
                    places = rows.field("positions")
                    counts = places.value_lengths().to_numpy()
                    position = places.flatten().to_numpy().astype(np.int64)
                    mask = np.repeat(rows.field("mask").to_numpy(), counts)
                    gone = covered(begins_of(position, mask, size), size)
                change = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                begins.append(change[::2].astype(np.int32))
                ends.append(change[1::2].astype(np.int32))
                left = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(change) else text
                kept.append(hashlib.sha256(left).digest() if digest else left)
                sizes.append(size)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(begins, pa.list_(pa.int32())),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["num", "ord", "n_bytes", "begins", "ends", "kept"])

    return read


def remove_repeats(
    docs: DataFrame,
    work: Workspace,
    id: str = "doc_id",
    text: str = "text",
    digest: bool = False,
    most_of_anchor: int = MOST_OF_ANCHOR,
) -> DataFrame:
    """One row per input row: id, n_bytes, begins, ends (the removed byte runs), kept (what is left).

    A byte is removed when a string of LENGTH bytes that covers it also begins in a document with a
    smaller id. With `digest`, `kept` is the SHA-256 of what is left. Null texts count as empty.
    Documents without an id come after all others and not before each other; rows with one id are
    one document as far as copies go. Texts with less than LENGTH bytes are left as they are. An
    empty table gives no rows.
    """
    work = work.inner()
    body = F.coalesce(F.col(text), F.lit(""))
    order = F.coalesce(F.col(id).cast("long"), F.lit(LAST))
    rows = docs.select(F.col(id).alias("id"), order.alias("ord"), F.sha2(body, 256).alias("hex"), body.alias("text"))
    rows, listed = numbered(rows, work)
    total = listed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first().n
    table, texts = distinct_texts(to_python(rows.select("num", "ord", "text")), work)

    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    found = texts.select("num", "text").mapInArrow(
        _anchor_rows(buckets), "bucket int, num long, nums binary, counts binary, keys binary"
    )
    found = work.store(found, "repeat_anchors")
    sent = found.filter("bucket is not null").select("bucket", "nums", "counts", "keys")
    met = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_repeated_in_bucket, "num long, keys binary")
    keys = found.filter("bucket is null").select("num", "keys").unionByName(met)
    keys = keys.groupBy("num").agg(F.collect_list("keys").alias("keys"))

    around = texts.join(keys, "num").select("num", "ord", "text", "keys").mapInArrow(_context_rows, CONTEXT)
    around = around.repartition("key").sortWithinPartitions("key")
    repeats = work.store(around.mapInArrow(_repeats(most_of_anchor), FOUND), "repeat_found")
    masks = repeats.filter("string is null").select("num", "positions", "mask")
    crowded = repeats.filter("string is not null")
    if crowded.take(1):
        least = crowded.groupBy("string").agg(F.min("ord").alias("least"))
        least = work.store(least, "repeat_strings")
        masks = masks.unionByName(
            crowded.join(least, "string").filter("least < ord").select("num", "positions", "mask")
        )
    masks = masks.groupBy("num").agg(F.collect_list(F.struct("positions", "mask")).alias("masks"))

    results = texts.join(masks, "num", "left").select("num", "ord", "text", "masks")
    results = work.store(results.mapInArrow(_removed(digest), RESULT), "repeat_results")
    work.remove(keep=["repeat_rows", "repeat_renumbered", "repeat_results"])
    docs.sparkSession.sql(f"DROP TABLE {table}")
    results = results.withColumnsRenamed({"num": "r_num", "ord": "least", "n_bytes": "r_bytes"})
    # Every copy of a text in a later document is a repeat from end to end.
    whole = (F.col("ord") > F.col("least")) & (F.col("n_bytes") >= LENGTH)
    nothing = F.unhex(F.sha2(F.lit(""), 256)) if digest else F.lit(b"")
    return listed.join(results, F.col("num") == F.col("r_num")).select(
        "id",
        "n_bytes",
        F.when(whole, F.array(F.lit(0))).otherwise(F.col("begins")).alias("begins"),
        F.when(whole, F.array(F.col("n_bytes").cast("int"))).otherwise(F.col("ends")).alias("ends"),
        F.when(whole, nothing).otherwise(F.col("kept")).alias("kept"),
    )
