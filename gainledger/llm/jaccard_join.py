"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Documents with equal shingle sets form one class, and only classes are joined. Shingles are ordered
from rare to frequent; two sets that are similar enough share a shingle among the first few of that
order, so classes meet on those only. What meets is filtered by length, by position and by a bound
on the difference of the rest, and then verified once on the whole sets.

What is wanted are groups, so pairs inside a group that is already linked up are not looked at:
rounds of stars (each shared shingle offers one class to all others) link up most groups, and an
exact last step takes every remaining pair of classes that are not yet in the same group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .bpe import small_batches
from .common import free_name, lookup, numbered, tasks_for, to_python
from .components import connected

SHINGLE_WORDS = 5
PERCENT = 80

# Counters of the frequency sketch (a fixed size, whatever the corpus) and how they travel: as bytes,
# so a task's count of a counter goes up to 255, which is frequent at any size.
COUNTERS = 1 << 22
BLOCK = 1 << 12
# Rounds of stars at most, and the comparisons per posting up to which the last step takes over.
STAR_ROUNDS = 6
# In the first round, before anything is linked up, it does so only where pairs are few.
PAIRS_PER_POSTING, FEW_PER_POSTING = 200, 2
# Cells of the histogram behind the suffix filter.
CELLS = 64

# Bytes of text hashed at once.
CUT_BYTES = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and hash of every word, taking a bounded piece of the text at a time."""
    begins, hashes, at = [], [], 0
    while at < len(data):
        cut = _SPACE.search(data, at + CUT_BYTES)
        end = cut.start() if cut else len(data)
        raw = np.frombuffer(data, np.uint8, end - at, at)
        inside = ~_IS_SPACE[raw]
        starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
        if len(starts):
            sizes = np.diff(np.append(starts, len(raw)))
            place = np.arange(len(raw))
            place[: starts[0]] = 0
            place[starts[0] :] -= np.repeat(starts, sizes)
            power = np.cumprod(np.full(int(place.max()) + 1, _BASE, np.uint64))
            value = np.where(inside, (raw.astype(np.uint64) + np.uint64(1)) * power[place], np.uint64(0))
            begins.append(starts + at)
            hashes.append(_mixed(np.add.reduceat(value, starts)))
        at = end
    if not begins:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(begins), np.concatenate(hashes)


def shingle_sets(texts: list[str | None], words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A-Z count as a-z. A text with fewer words is one shingle of all its words; a text without words,
    or null, has none.
    """
    data = [(t or "").encode().lower() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data]) if data else np.zeros(0, np.int64)
    begins, hashes = hashed_words(b"\n".join(data))
    upto = np.searchsorted(begins, ends).tolist()
    long = max(0, len(hashes) - words + 1)
    chain = np.zeros(long, np.uint64)
    for k in range(words):
        chain = chain * _BASE + hashes[k : k + long]
    chain = _mixed(chain)
    first = 0
    for last in upto:
        n = last - first
        if n >= words:
            yield np.unique(chain[first : last - words + 1])
        elif n:
            short = np.full(1, n, np.uint64)
            for h in hashes[first:last]:
                short = short * _BASE + h
            yield _mixed(_mixed(short))
        else:
            yield np.zeros(0, np.uint64)
        first = last


def class_of(found: np.ndarray) -> int:
    """A 64-bit name of a shingle set."""
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def needed(a: Column, b: Column, percent: int) -> Column:
    """The least intersection of sets of sizes a and b that are similar enough."""
    return F.ceil(percent * (a + b) / (100 + percent))


def may_link(percent: int, a: str = "a", b: str = "b") -> Column:
    """Length and positional filter of two postings of one shingle, (a, na, pa) and (b, nb, pb)."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    rest = F.least(na - F.col(f"p{a}"), nb - F.col(f"p{b}"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (rest >= needed(na, nb, percent))


def may_meet(tokens: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Which of the postings, sorted by token and size, may link with another of their token.

    The sizes next to a posting's own are the nearest, so they settle the length filter; where just
    two classes share a token, the positional filter is settled as well.
    """
    same = np.zeros(len(tokens) + 1, bool)  # same[i]: rows i - 1 and i have one token
    same[1:-1] = tokens[1:] == tokens[:-1]
    n = n.astype(np.int64)
    near = np.zeros(len(tokens) + 1, bool)
    near[1:-1] = same[1:-1] & (100 * n[:-1] >= percent * n[1:])
    two = same.copy()  # rows i - 1 and i are all that have the token
    two[1:] &= ~same[:-1]
    two[:-1] &= ~same[1:]
    rest = np.minimum(n[1:] - pos[1:], n[:-1] - pos[:-1])
    near[1:-1] &= ~two[1:-1] | ((100 + percent) * rest >= percent * (n[1:] + n[:-1]))
    return near[:-1] | near[1:]


def marked_documents(docs: DataFrame, work: Workspace, id: str, text: str, words: int) -> tuple[DataFrame, np.ndarray]:
    """Stored (id, n, class, cells) of every row, and how frequent the shingles of each counter are.

    One pass over the texts: every task also counts its shingles in a sketch of fixed size, which is
    summed block by block. The counts only decide the order of shingles, so a counter shared by
    several shingles costs time at most.
    """
    kind = docs.schema[id].dataType.simpleString()
    names = ["id", "n", "class", "cells", "block", "counts"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        id_type = None
        for whole in batches:
            id_type = whole.column(0).type
            for batch in small_batches(whole, 1):
                sizes, classes, cells = [], [], []
                for found in shingle_sets(batch.column(1).to_pylist(), words):
                    sizes.append(len(found))
                    classes.append(class_of(found) if len(found) else None)
                    cells.append(np.bincount((found >> np.uint64(58)).astype(np.int64), minlength=CELLS).astype("<u4").tobytes())
                    np.add.at(counts, (found % np.uint64(COUNTERS)).astype(np.int64), np.uint32(1))
                n = len(sizes)
                columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()), pa.array(cells, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        if id_type is not None:
            rows = np.minimum(counts, 255).astype(np.uint8).reshape(-1, BLOCK)
            n = len(rows)
            columns = [pa.nulls(n, id_type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        done: list[tuple] = []
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != now:
                    if now is not None:
                        done.append((now, total))
                    now, total = block, np.zeros(BLOCK, np.uint64)
                total = total + np.frombuffer(raw, np.uint8)
        if now is not None:
            done.append((now, total))
        if done:
            levels = [np.minimum(255, 8 * np.log2(1 + t.astype(float))).astype(np.uint8).tobytes() for _, t in done]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in done], pa.int32()), pa.array(levels, pa.binary())], ["block", "level"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    marks = work.store(to_python(rows).mapInArrow(mark, f"id {kind}, n int, class long, cells binary, block int, counts binary"), "shingle_marks")
    sketch = marks.filter("block is not null").select("block", "counts").repartition("block").sortWithinPartitions("block")
    levels = np.zeros((COUNTERS // BLOCK, BLOCK), np.uint8)
    for r in sketch.mapInArrow(summed, "block int, level binary").collect():  # COUNTERS bytes in all
        levels[r.block] = np.frombuffer(r.level, np.uint8)
    return marks.filter("block is null").select("id", "n", "class", "cells"), levels.ravel()


def shared_postings(docs: DataFrame, work: Workspace, levels: np.ndarray, text: str, words: int, percent: int) -> DataFrame:
    """Stored (token, class, n, pos): shingles in the prefixes of classes that may link, pos from 0."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, done = shared.value, set()
        for whole in batches:
            for batch in small_batches(whole, 0):
                out: list[list[np.ndarray]] = [[], [], [], []]
                for found in shingle_sets(batch.column(0).to_pylist(), words):
                    n = len(found)
                    if not n or (name := class_of(found)) in done:
                        continue
                    done.add(name)
                    keep = n - -(-percent * n // 100) + 1
                    level = levels[(found % np.uint64(COUNTERS)).astype(np.int64)]
                    first = found[np.argsort(level, kind="stable")[:keep]]  # rare first, then by hash
                    for column, value in zip(out, (first.view(np.int64), np.full(keep, name), np.full(keep, n, np.int32), np.arange(keep, dtype=np.int32)), strict=True):
                        column.append(value)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["token", "class", "n", "pos"])

    def only_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drops postings that can link with no other of their token; rows come sorted by token and
        size. What is known of a row depends on two rows on either side, so four are carried over."""
        carried: pa.RecordBatch | None = None
        decided = 0  # leading rows of `carried` that are there as context only
        for batch in batches:
            if not batch.num_rows:
                continue
            if carried is not None:
                batch = pa.Table.from_batches([carried, batch]).combine_chunks().to_batches()[0]
            tokens, classes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            fresh = np.ones(len(tokens), bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])
            batch = batch.filter(pa.array(fresh))
            keep = may_meet(*(batch.column(i).to_numpy() for i in (0, 2, 3)), percent)
            last = max(decided, batch.num_rows - 2)
            keep[:decided] = keep[last:] = False
            if keep.any():
                yield batch.filter(pa.array(keep))
            begin = max(0, last - 2)
            carried, decided = batch.slice(begin), last - begin
        if carried is not None:
            keep = may_meet(*(carried.column(i).to_numpy() for i in (0, 2, 3)), percent)
            keep[:decided] = False
            if keep.any():
                yield carried.filter(pa.array(keep))

    rows = to_python(docs.select(F.col(text).alias("text"))).mapInArrow(prefixes, "token long, class long, n int, pos int")
    sorted_rows = rows.repartition("token").sortWithinPartitions("token", "n", "class")
    return work.store(sorted_rows.mapInArrow(only_shared, "token long, class long, n int, pos int"), "shingle_postings")


def whole_sets(
    docs: DataFrame, work: Workspace, classes: DataFrame, wanted: DataFrame, id: str, text: str, words: int, name: str
) -> DataFrame:
    """Stored (class, found) of the classes in `wanted`, read from the first document of each."""
    first = classes.join(wanted, F.col("class") == F.col("want")).select("first").distinct()
    first = lookup(work.store(first, f"{name}_wanted"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, 0):
                found = [f for f in shingle_sets(batch.column(0).to_pylist(), words) if len(f)]
                columns = [pa.array([class_of(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["class", "found"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    chosen = rows.join(first, F.col("id").eqNullSafe(F.col("first")), "left_semi").select("text")
    return work.store(to_python(chosen).mapInArrow(read, "class long, found binary"), f"{name}_sets")


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter.

    It needs the histograms only: over the cells of the hash range the sizes of two sets differ by
    no more than the sets do.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(n, CELLS).astype(np.int64) for i in (2, 3))
            total = a.sum(axis=1) + b.sum(axis=1)
            least = -(-percent * total // (100 + percent))
            keep = pa.array(np.abs(a - b).sum(axis=1) <= total - 2 * least)
            yield batch.select([0, 1]).filter(keep)

    cells = classes.select("class", "cells")
    sketched = pairs.join(cells.withColumnsRenamed({"class": "a", "cells": "ca"}), "a").join(
        cells.withColumnsRenamed({"class": "b", "cells": "cb"}), "b"
    )
    return sketched.select("a", "b", "ca", "cb").mapInArrow(near, "a long, b long")


def verified(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    full = sets.select("class", "found")
    joined = likely.join(full.withColumnsRenamed({"class": "a", "found": "fa"}), "a").join(
        full.withColumnsRenamed({"class": "b", "found": "fb"}), "b"
    )
    return joined.select("a", "b", "fa", "fb").mapInArrow(check, "a long, b long")


def star_pairs(labelled: DataFrame, percent: int, round: int) -> DataFrame:
    """Pairs of each token's centre with the classes of other groups that meet it there.

    In the first round the centre is the class that meets most others, later a random one.
    """
    luck = F.xxhash64("class", F.lit(round)).cast("double")
    score = F.col("weight").cast("double") if round == 1 else luck
    centre = labelled.groupBy("token").agg(F.max(F.struct(score.alias("score"), "class", "n", "pos", "group")).alias("c"))
    centre = centre.select("token", *[F.col(f"c.{x}").alias(y) for x, y in (("class", "a"), ("n", "na"), ("pos", "pa"), ("group", "ga"))])
    members = labelled.select("token", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("group").alias("gb"))
    return members.join(centre, "token").filter((F.col("ga") != F.col("gb")) & may_link(percent)).select("a", "b").distinct()


def rest_pairs(labelled: DataFrame, percent: int) -> DataFrame:
    """Every pair of postings of a token whose classes are in different groups."""
    side = lambda x: labelled.select(
        "token", F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}"), F.col("group").alias(f"g{x}")
    )
    return side("a").join(side("b"), "token").filter((F.col("ga") < F.col("gb")) & may_link(percent)).select("a", "b").distinct()


def linked_classes(postings: DataFrame, classes: DataFrame, work: Workspace, percent: int, read_sets) -> DataFrame:
    """(node, component) of the classes that are linked with any other.

    `read_sets(wanted, name)` gives the sets of the classes in `wanted` (want).
    """
    weights = postings.groupBy(F.col("class").alias("w_class")).agg((F.count("*") / F.first("n")).alias("weight"))
    weights = work.store(weights, "shingle_weights")
    weighted = work.store(postings.join(weights, F.col("class") == F.col("w_class")).drop("w_class"), "shingle_weighted")
    size = weighted.count()
    tasks = tasks_for(size)
    links, groups, sets = None, None, None
    for round in range(1, STAR_ROUNDS + 2):
        name = f"shingle_round_{round}"
        if groups is None:
            labelled = weighted.withColumn("group", F.col("class"))
        else:
            labelled = weighted.join(groups, F.col("class") == F.col("node"), "left")
            labelled = labelled.withColumn("group", F.coalesce("component", "class")).drop("node", "component")
            # Tokens whose classes are all in one group have nothing left to find.
            spread = labelled.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most")).filter("least <> most")
            spread = work.store(spread.select("token").coalesce(tasks), f"{name}_spread")
            labelled = work.store(labelled.join(lookup(spread), "token", "left_semi").coalesce(tasks), f"{name}_postings")
        by_group = labelled.groupBy("token", "group").agg(F.count("*").alias("k"))
        by_token = by_group.groupBy("token").agg((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))).alias("ordered"))
        open_pairs = by_token.agg(F.coalesce(F.sum("ordered") / 2, F.lit(0.0)).alias("x")).first().x
        few = FEW_PER_POSTING if round == 1 else PAIRS_PER_POSTING
        last = open_pairs <= few * size or round > STAR_ROUNDS
        pairs = rest_pairs(labelled, percent) if last else star_pairs(labelled, percent, round)
        pairs = work.store(pairs.coalesce(tasks), f"{name}_pairs")
        likely = work.store(likely_pairs(pairs, classes, percent).coalesce(tasks), f"{name}_likely")
        wanted = likely.select(F.explode(F.array("a", "b")).alias("want")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("class"), F.col("want") == F.col("class"), "left_anti")
        more = read_sets(wanted, name)
        sets = more if sets is None else sets.unionByName(more)
        found = work.store(verified(likely, sets, percent).coalesce(tasks), f"{name}_links")
        links = found if links is None else links.unionByName(found)
        groups = connected(links, work, f"{name}_groups")
        if last:
            return groups
    raise AssertionError("the last round returns")


def jaccard_groups(
    docs: DataFrame,
    work: Workspace,
    id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links).

    Two rows are linked when 100 x intersection >= percent x union of their shingle sets. Null and
    blank texts have no shingles and link with nothing. Rows repeated with the same id and text
    have the same component. Null ids come last: a component's id is null only when all its ids
    are. An empty table gives no rows. Sets are compared by 64-bit hashes of their shingles.
    """
    work = work.inner()
    marks, levels = marked_documents(docs, work, id, text, words)
    classes = marks.filter("n > 0").groupBy("class").agg(F.min("id").alias("first"), F.any_value("cells").alias("cells"))
    classes = work.store(classes, "shingle_classes")
    postings = shared_postings(docs, work, levels, text, words, percent)
    read_sets = lambda wanted, name: whole_sets(docs, work, classes, wanted, id, text, words, name)
    groups = linked_classes(postings, classes, work, percent, read_sets)

    firsts = classes.join(groups, F.col("class") == F.col("node"), "left").select(
        "class", "first", F.coalesce("component", "class").alias("group")
    )
    firsts = work.store(firsts, "shingle_firsts")
    least = firsts.groupBy("group").agg(F.min("first").alias("component_id"))
    known = firsts.join(least, "group").select(F.col("class").cast("string").alias("known"), "component_id")
    known = work.store(known, "shingle_known")
    work.remove(keep=["shingle_marks", "shingle_known"])
    # Rows without shingles get a key of their own, so that they do not meet in one task.
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    keyed = marks.withColumn("key", F.coalesce(F.col("class").cast("string"), alone))
    return keyed.join(known, F.col("key") == F.col("known"), "left").select(
        "id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, work: Workspace, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each group of near copies, with its own columns only.

    The row with the smallest id stays, null ids last; of rows with one id, the first stored. Rows
    are told apart by a number, so what goes is a row and not all that share its id; `docs` is as
    read from files, or else copied once.
    """
    work = work.inner()
    row, name = free_name(docs, "row_number"), free_name(docs, "gone")
    rows = numbered(docs, work, row)
    # Structs are ordered by their fields.
    order = F.struct(F.col(id).isNull().alias("absent"), F.col(id).alias("id"), F.col(row).alias("row"))
    keyed = rows.select(order.alias("id"), F.col(text).alias("text"))
    groups = jaccard_groups(keyed, work, "id", "text")
    gone = groups.filter(F.col("id") != F.col("component_id")).select(F.col("id.row").alias(name))
    gone = lookup(work.store(gone, "shingle_gone"))
    work.remove(keep=[f"{row}_input", f"{row}_files", "shingle_gone"])
    return rows.join(gone, F.col(row) == F.col(name), "left_anti").select(*[f"`{c}`" for c in docs.columns])
