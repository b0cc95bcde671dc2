"""Chat formatting by columnar byte assembly.

Every turn becomes header + escaped text + footer. For a batch of turns the lengths of all these
segments are known as arrays, their cumulative sums are the offsets in the output, and one scatter
copies the bytes of all segments into one preallocated Arrow buffer.

A mark inside a text is defused by a backslash after its `<`; a `<` already followed by backslashes
and a bar gets one more, so the escape can be undone: `<|` -> `<\\|`, `<\\|` -> `<\\\\|`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .common import to_python

# Fixed values of the template.
BEGIN, HEAD_END, FOOTER = "<|im_start|>", "\n", "<|im_end|>\n"
LOSS_ROLE = "assistant"
ESCAPE = (r"<(\\*)\|", r"<\\\1|")
UNESCAPE = (re.compile(r"<\\(\\*)\|"), r"<\1|")

# Bytes that one assembly handles, and the size at which a part of a conversation is closed.
ASSEMBLY_BYTES = 4 << 20
PART_BYTES = 32 << 20

PARTS = "conv {id}, part long, formatted string, loss array<struct<begin:int,end:int>>, whole boolean"


def escape_role(role: str) -> str:
    """A role in one line and without marks."""
    return re.sub(*ESCAPE, role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    plain = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
    return UNESCAPE[0].sub(UNESCAPE[1], plain)


def unescape(text: str) -> str:
    return UNESCAPE[0].sub(UNESCAPE[1], text)


def scatter(sources: list[np.ndarray], begins: list[np.ndarray], lengths: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """Lays segments out one after the other in one new buffer.

    Segment j of row i is `lengths[i, j]` bytes of `sources[j]` from `begins[j][i]` on. Returns the
    buffer and the offset of every segment, with the total at the end.
    """
    offsets = np.concatenate([[0], np.cumsum(lengths.ravel())])
    buffer = pa.allocate_buffer(int(offsets[-1]))
    out = np.frombuffer(buffer, np.uint8)
    places = offsets[:-1].reshape(lengths.shape)
    for j, source in enumerate(sources):
        length = lengths[:, j]
        total = int(length.sum())
        within = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
        out[np.repeat(places[:, j], length) + within] = source[np.repeat(begins[j], length) + within]
    return buffer, offsets


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The formatted turns of a batch in one buffer, and the offsets of (header, text, footer)."""
    coded = pc.dictionary_encode(pc.fill_null(roles, ""))
    heads = [(BEGIN + escape_role(r) + HEAD_END).encode() for r in coded.dictionary.to_pylist()]
    head_sizes = np.array([len(h) for h in heads], np.int64)
    which = coded.indices.to_numpy()
    escaped = pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=ESCAPE[0], replacement=ESCAPE[1])
    spots = np.frombuffer(escaped.buffers()[1], np.int32, len(escaped) + 1, escaped.offset * 4).astype(np.int64)
    body = escaped.buffers()[2]
    foot = np.frombuffer(FOOTER.encode(), np.uint8)
    n = len(escaped)
    lengths = np.stack([head_sizes[which], np.diff(spots), np.full(n, len(foot))], axis=1)
    sources = [
        np.frombuffer(b"".join(heads), np.uint8),
        np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8),
        foot,
    ]
    begins = [(np.cumsum(head_sizes) - head_sizes)[which], spots[:-1], np.zeros(n, np.int64)]
    return scatter(sources, begins, lengths)


class OpenPart:
    """A part of one conversation that is still growing."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.chunks, self.loss = conv, number, [], []
        self.bytes = self.chars = 0

    def add(self, text: str, size: int, loss: list[tuple[int, int]]) -> None:
        self.loss += [(a + self.chars, b + self.chars) for a, b in loss]
        self.chunks.append(text)
        self.chars += len(text)
        self.bytes += size


def _as_batch(parts: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    kinds = [kind, pa.int64(), pa.string(), spans, pa.bool_()]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*parts, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["conv", "part", "formatted", "loss", "whole"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats sorted turns of one task. The conversations at both ends of the task may go on in its
    neighbours, so their parts are not marked as whole."""
    now: OpenPart | None = None
    first, kind = True, pa.int64()
    for whole_batch in batches:
        kind = whole_batch.column(0).type
        for batch in _bounded(whole_batch):
            convs, roles, texts = (batch.column(i) for i in range(3))
            buffer, offsets = assemble(roles, texts)
            ids, names = convs.to_pylist(), roles.to_pylist()
            spots = offsets[::3].tolist()
            data = memoryview(buffer)
            closed, begin = [], 0
            while begin < len(ids):
                end = begin + 1
                while end < len(ids) and ids[end] == ids[begin]:
                    end += 1
                text = str(data[spots[begin] : spots[end]], "utf-8")
                loss, chars = [], 0
                for i in range(begin, end):
                    head, body = offsets[3 * i + 1], offsets[3 * i + 2]
                    chars += len(str(data[spots[i] : head], "utf-8"))
                    size = len(str(data[head:body], "utf-8"))
                    if names[i] == LOSS_ROLE:
                        loss.append((chars, chars + size))
                    chars += size + len(FOOTER)
                if now is not None and now.conv != ids[begin]:
                    closed.append((now.conv, now.number, "".join(now.chunks), now.loss, not first and now.number == 0))
                    first, now = False, None
                if now is not None and now.bytes > PART_BYTES:
                    closed.append((now.conv, now.number, "".join(now.chunks), now.loss, False))
                    now = OpenPart(ids[begin], now.number + 1)
                now = now or OpenPart(ids[begin], 0)
                now.add(text, spots[end] - spots[begin], loss)
                begin = end
            if closed:
                yield _as_batch(closed, kind)
    if now is not None:
        yield _as_batch([(now.conv, now.number, "".join(now.chunks), now.loss, False)], kind)


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().astype(np.int64)
    piece = np.cumsum(sizes) // ASSEMBLY_BYTES
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(piece, piece[begin], "right"))
        yield batch.slice(begin, end - begin)
        begin = end


def format_conversations(
    turns: DataFrame,
    work: Workspace,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Parts of formatted conversations: conv, part_order, part, formatted, loss, whole.

    Turns are ordered by turn (null first), then role and text, so that repeated turns stand in a
    fixed order; null role and text count as empty; the turns without a conversation id form one
    conversation. `loss` lists the character spans of the assistant's texts. Tasks get ranges of
    (conversation, turn), so that a conversation of any length is formatted by many tasks, in parts
    of bounded size; (part_order, part) puts the parts of a conversation in order. `whole` marks
    conversations that consist of that one part for sure. An empty table gives no rows.
    """
    kind = turns.schema[conv].dataType.simpleString()
    columns = [conv, turn, role, text]
    rows = turns.select(*[F.col(c).alias(a) for c, a in zip(columns, ["conv", "turn", "role", "text"], strict=True)])
    order = ["conv", "turn", "role", "text"]
    ranged = rows.repartitionByRange("conv", "turn").sortWithinPartitions(*order)
    parts = to_python(ranged.select("conv", "role", "text")).mapInArrow(_format, PARTS.format(id=kind))
    return work.store(parts.withColumn("part_order", F.spark_partition_id()), "chat_parts")


class Readback:
    """Digests of one conversation, read back from its formatted parts."""

    def __init__(self, conv):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        at = 0
        while at < len(formatted):
            head = formatted.index(HEAD_END, at + len(BEGIN))
            foot = formatted.index(FOOTER, head + 1)
            role = unescape_role(formatted[at + len(BEGIN) : head])
            self.turns.update(f"{role}\n{unescape(formatted[head + 1 : foot])}\n".encode())
            self.n += 1
            at = foot + len(FOOTER)
        for span in loss:
            text = unescape(formatted[span["begin"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


READBACK = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of formatted conversations, by parsing the formatted text and the loss spans.

    Whole conversations are read where they are. Only the parts of the others (two for each task,
    and long conversations) meet by conversation; they are read in order, one part at a time.
    """
    kind = parts.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        id_type = pa.int64()
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(zip(*rows, strict=True), [id_type, *kinds], strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in columns], READBACK)

        for batch in batches:
            id_type = batch.column(0).type
            for conv, formatted, loss in zip(*(c for c in batch.columns), strict=True):
                conv = conv.as_py()
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = Readback(conv)
                now.read(formatted.as_py(), loss.as_py())
            if done:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([*done, now.row()])

    columns = ["conv", "formatted", "loss"]
    whole = parts.filter("whole").select(*columns)
    others = parts.filter("not whole").repartition("conv").sortWithinPartitions("conv", "part_order", "part")
    return whole.mapInArrow(read, schema).unionByName(others.select(*columns).mapInArrow(read, schema))
