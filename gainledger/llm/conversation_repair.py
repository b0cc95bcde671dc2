"""Repair of damaged conversations by an automaton that shares suffixes.

Rows are ordered by ranges of (conversation, turn), so that tasks get rows, not conversations; each
task writes the rows of a conversation as parts of bounded size with one signature each (see
repair_automaton). The different signatures of the whole corpus, sorted from their ends, become the
automaton: cost-to-go and best audit are found once for every node. Parts then look up their audit.

A conversation that lies in several parts is folded: each part is a function from what follows it
(one of a few classes) to what is before it, so the parts of a conversation are placed by going over
these narrow functions once from the end and once from the beginning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import LOOKUP_ROWS, SPACES, lookup, to_python
from .repair_automaton import KEEP_TO, STATES, WANTED, WANTED_TO, Automaton, classes, pass_through, read_audit

# Fixed values of the contract: adjacent role initials that are in order, and what ends a sentence.
IN_ORDER = {"su", "ua", "au"}
SENTENCE_ENDS = [".", "!", "?"]

# Rows, and bytes of text, at which a part is closed.
PART_ROWS = 1 << 15
PART_BYTES = 4 << 20
# Bytes of signatures and audits that may be broadcast once they are counted.
LOOKUP_BYTES = 32 << 20

COUNTS = ["blank", "duplicate", "truncated", "illegal"]
PARTS = (
    "conv {id}, part int, whole boolean, signature string, roles array<string>, texts array<string>, "
    "first string, last string, blank long, duplicate long, truncated long, illegal long"
)
REPAIRED = "conv {id}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) after the damage that the checksum of conv:turn decides.

    Nulls are one space: in the checksum's text, and as role and text. Dropped rows have no copies.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv", "turn")])
    fate = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    return rows.select(
        "conv",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def _met_at_two_turns(rows: DataFrame) -> DataFrame:
    """(conv, role, digest) that a conversation holds at several turns, with the first of them."""
    turn = F.struct(F.col("turn").isNotNull().alias("dated"), "turn")
    met = rows.filter("not blank").groupBy("conv", "role", F.sha2("text", 256).alias("digest"))
    met = met.agg(F.min(turn).alias("head"), F.max(turn).alias("tail")).filter("head <> tail")
    return met.select("conv", "role", "digest", F.col("head.turn").alias("head"))


def _faults(rows: DataFrame, work: Workspace) -> DataFrame:
    """Damaged rows with their fault, apart from repetitions inside one turn: b, d, t or none."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.filter("copies > 0").withColumn("blank", bare == "")
    met = lookup(work.store(_met_at_two_turns(rows), "repeated_texts"))
    met = met.select(*[F.col(c).alias(f"met_{c}") for c in met.columns])
    same = F.col("conv").eqNullSafe(F.col("met_conv")) & (F.col("role") == F.col("met_role"))
    same &= (F.sha2("text", 256) == F.col("met_digest")) & ~F.col("blank")
    rows = rows.join(met, same, "left")
    later = F.col("met_digest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("met_head"))
    ended = F.substring(bare, -1, 1).isin(SENTENCE_ENDS)
    fault = F.when(F.col("blank"), "b").when(later, "d").when(~ended, "t").otherwise("")
    return rows.select("conv", "turn", "role", "text", "copies", fault.alias("fault"))


class OpenPart:
    """A part of one conversation that is still growing."""

    def __init__(self, conv, number: int):
        self.conv, self.number = conv, number
        self.signature, self.roles, self.texts = [], [], []
        self.first = self.last = None
        self.counts = dict.fromkeys(COUNTS, 0)
        self.bytes = 0

    def add(self, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in IN_ORDER:
            self.counts["illegal"] += 1
        self.last = initial
        kind = {"b": "blank", "d": "duplicate", "t": "truncated"}.get(fault)
        if kind:
            self.counts[kind] += 1
        if fault in ("b", "d"):
            self.signature.append("x")
            return
        letter = initial if initial in ("s", "u", "a") else "o"
        self.signature.append(letter.upper() if fault == "t" else letter)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text)

    def full(self) -> bool:
        return len(self.signature) >= PART_ROWS or self.bytes >= PART_BYTES

    def row(self, whole: bool) -> tuple:
        signature = "".join(self.signature)
        own = (self.conv, self.number, whole, signature, self.roles, self.texts, self.first, self.last)
        return (*own, *self.counts.values())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a task as parts. The conversations at both ends of the task may go on in its
    neighbours, so their parts are not marked as whole."""
    texts = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.string(), texts, texts, pa.string(), pa.string(), *[pa.int64()] * 4]
    names = ["conv", "part", "whole", "signature", "roles", "texts", "first", "last", *COUNTS]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in columns], names)

    # Parts are numbered through the task, which may hold pieces of two conversations.
    now: OpenPart | None = None
    head = 0  # the number of the conversation's first part here
    inner, before = False, None  # whether the conversation began in this task; the row before
    for batch in batches:
        kinds[0] = batch.column(0).type
        closed, size = [], 0
        for conv, turn, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    closed.append(now.row(whole=inner and now.number == head))
                    size += now.bytes
                    inner, head = True, now.number + 1
                now, before = OpenPart(conv, head), None
            for _ in range(copies):
                if now.full():
                    closed.append(now.row(whole=False))
                    size += now.bytes
                    now = OpenPart(conv, now.number + 1)
                row = (turn, role, text)
                now.add(role, text, "d" if row == before and fault != "b" else fault)
                before = row
            if size >= PART_BYTES:
                yield batch_of(closed)
                closed, size = [], 0
        if closed:
            yield batch_of(closed)
    if now is not None:
        yield batch_of([now.row(whole=False)])


def _conversation_parts(rows: DataFrame, work: Workspace) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "text"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = PARTS.format(id=kind)
    parts = to_python(ranged).mapInArrow(_cut, schema).withColumn("task", F.spark_partition_id())
    return work.store(parts, "conversation_parts")


def _placed(split: DataFrame, work: Workspace) -> DataFrame:
    """(task, part, closing, class, state) of parts: whether one ends its conversation, the class of
    what follows it, and the grammar state before it.

    Parts travel as the functions they are: a few hundred bytes for at least `PART_ROWS` rows, or for
    the two ends of a task.
    """
    kind = split.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, task int, part int, classes array<int>, states array<int>"

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pass_through(signature.as_py()) for signature in batch.column(3)]
            columns = [pa.array([f[k].ravel().tolist() for f in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["conv", "task", "part", "classes", "states"])

    def fold(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by([("task", "ascending"), ("part", "ascending")])
        n = parts.num_rows
        classes, states = parts["classes"].to_pylist(), parts["states"].to_pylist()
        follows, now = [0] * n, 0
        for k in reversed(range(n)):
            follows[k], now = now, classes[k][now]
        before, state = [0] * n, 0
        for k in range(n):
            before[k], state = state, states[k][len(STATES) * follows[k] + state]
        columns = [pa.array(follows, pa.int32()), pa.array(before, pa.int32())]
        closing = pa.array(np.arange(n) == n - 1)
        return pa.table([parts["task"], parts["part"], closing, *columns], ["task", "part", "closing", "class", "state"])

    narrow = split.select("conv", "task", "part", "signature").mapInArrow(functions, schema)
    placed = narrow.groupBy("conv").applyInArrow(fold, "task int, part int, closing boolean, class int, state int")
    return work.store(placed, "placed_parts")


PLACE = ["closing", "class", "state", "signature"]


def _audits(places: DataFrame, work: Workspace) -> DataFrame:
    """The best audit and its cost for every (closing, class, state, signature) met in the corpus.

    Signatures are sorted from their ends, and tasks get ranges of them, so each task goes once over
    the nodes of its part of the automaton.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, rest = Automaton(), classes()[0]
        for batch in batches:
            audits, costs = [], []
            for closing, number, state, signature in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                node = automaton.node(closing, number, signature)
                audit, end = read_audit(node.audits[state])
                audits.append(audit)
                costs.append(node.costs[state] - (0 if closing else rest[number][end]))
            columns = [*batch.columns, pa.array(audits, pa.string()), pa.array(costs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*PLACE, "audit", "cost"])

    order = ["closing", "class", F.reverse("signature"), "state"]
    met = places.select(*PLACE).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "closing boolean, class int, state int, signature string, audit string, cost long"
    audits = work.store(to_python(met).mapInArrow(walk, schema), "audits")
    size = audits.agg(F.count("*"), F.sum(F.length("signature") + F.length("audit"))).first()
    return F.broadcast(audits) if size[0] <= LOOKUP_ROWS and (size[1] or 0) <= LOOKUP_BYTES else audits


def _mended_parts(rows: DataFrame, work: Workspace) -> DataFrame:
    """Parts of conversations with their place and their audit."""
    parts = _conversation_parts(_faults(rows, work), work)
    placed = lookup(_placed(parts.filter("not whole"), work))
    whole = parts.filter("whole").select(
        "*", F.lit(True).alias("closing"), F.lit(0).alias("class"), F.lit(0).alias("state")
    )
    split = parts.filter("not whole").join(placed, ["task", "part"])
    placed_parts = whole.unionByName(split)
    return placed_parts.join(_audits(placed_parts, work), PLACE)


def _edits(part: dict) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that the repair of a part leaves or puts in."""
    signature, kept = iter(part["signature"]), iter(zip(part["roles"], part["texts"], strict=True))
    state = part["state"]
    for edit in part["audit"]:
        text = ""
        if edit != "I":
            if next(signature) == "x":
                continue
            role, text = next(kept)
            if edit == "D":
                continue
        if edit == "K":
            state = KEEP_TO[state][role[:1]]
        else:
            role, state = WANTED[state], WANTED_TO[state]
        yield edit, role, text


class Mended:
    """What is said of one conversation, from its parts in order."""

    def __init__(self, conv):
        self.conv, self.last = conv, None
        self.counts = dict.fromkeys(COUNTS, 0)
        self.cost, self.audits = 0, []
        self.hash, self.empty = hashlib.sha256(), True

    def read(self, part: dict) -> None:
        for name in COUNTS:
            self.counts[name] += part[name]
        if self.last is not None and self.last + part["first"] not in IN_ORDER:
            self.counts["illegal"] += 1
        self.last = part["last"]
        self.cost += part["cost"]
        self.audits.append(part["audit"])
        lines = [f"{role}:{text}" for _, role, text in _edits(part)]
        if lines:
            self.hash.update(("" if self.empty else "\n").encode() + "\n".join(lines).encode())
            self.empty = False

    def row(self) -> tuple:
        return (self.conv, *self.counts.values(), self.cost, "".join(self.audits), self.hash.hexdigest())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    kinds = [pa.int64(), *[pa.int64()] * 5, pa.string(), pa.string()]
    names = ["conv", *COUNTS, "cost", "audit", "repaired_sha256"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in columns], names)

    for batch in batches:
        kinds[0] = batch.schema.field("conv").type
        for row in range(batch.num_rows):
            part = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
            if now is None or now.conv != part["conv"]:
                if now is not None:
                    done.append(now.row())
                now = Mended(part["conv"])
            now.read(part)
        if done:
            yield batch_of(done)
            done = []
    if now is not None:
        yield batch_of([*done, now.row()])


def repair_digests(rows: DataFrame, work: Workspace) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` are (conv, turn, role, text, copies), such as `damaged` gives: no copies mean that the row
    is gone (its conversation is reported all the same), two that it stands there twice. Rows are
    ordered by turn (null first), then role and text. Rows without a conversation id form one
    conversation. `gaps` are missing turns between the least and the greatest; null turns do not
    count. A role whose initial is none of s, u and a, an empty one included, cannot be kept.
    Conversations without rows get zeros, an empty audit and the hash of the empty text; an empty
    table gives no rows. A conversation of any length is cut into parts of bounded size; only its hash
    is taken by one task, part by part.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    turn = F.when(F.col("copies") > 0, F.col("turn").cast("long"))
    gaps = F.max(turn) - F.min(turn) + 1 - F.countDistinct(turn)
    every = rows.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))

    columns = ["conv", "signature", "roles", "texts", "first", "last", *COUNTS, "state", "audit", "cost"]
    parts = _mended_parts(rows, work)
    whole = to_python(parts.filter("whole").select(*columns))
    split = parts.filter("not whole").repartition("conv").sortWithinPartitions("conv", "task", "part")
    schema = REPAIRED.format(id=kind)
    found = whole.mapInArrow(_digests, schema).unionByName(split.select(*columns).mapInArrow(_digests, schema))
    found = found.withColumnRenamed("conv", "found_conv")
    joined = every.join(found, F.col("conv").eqNullSafe(F.col("found_conv")), "left")
    return joined.select(
        "conv",
        "gaps",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in [*COUNTS, "cost"]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repaired_turns(rows: DataFrame, work: Workspace) -> DataFrame:
    """The rows of the repaired conversations: conv, task, part, seat (their order), edit, role, text.

    `edit` is K, R or I: kept, given another role, or put in. See `repair_digests` for the rows read.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, task int, part int, seat int, edit string, role string, text string"

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                lines = [*_edits(part)]
                if not lines:
                    continue
                place = [pa.array([part[c]] * len(lines), batch.schema.field(c).type) for c in ("conv", "task", "part")]
                seats = pa.array(range(len(lines)), pa.int32())
                texts = [pa.array(list(c), pa.string()) for c in zip(*lines, strict=True)]
                names = ["conv", "task", "part", "seat", "edit", "role", "text"]
                yield pa.RecordBatch.from_arrays([*place, seats, *texts], names)

    columns = ["conv", "task", "part", "signature", "roles", "texts", "state", "audit"]
    return to_python(_mended_parts(rows, work).select(*columns)).mapInArrow(turns, schema)
