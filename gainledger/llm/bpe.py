"""Byte-pair encoding with forced boundaries, and decoding.

A byte pair that occurs inside no token of the vocabulary can never be merged across, so it marks a
certain cut. Texts are cut there and where the pre-tokeniser's pattern ends a match; the fragments
are encoded independently (all new ones of a chunk at once, and remembered, as few are new) and their
ids put end to end.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_python
from .pair_merging import PairMerger, Remembered

# White space as the pattern means it, and the endings that follow an apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
LETTER, NUMBER, SPACE, OTHER, END = range(5)

# Characters handled at once, and fragments remembered (and as many of the time before).
CHUNK_CHARS = 1 << 18
REMEMBERED = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def character_classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    classes[WHITE] = SPACE
    return classes


class Vocabulary:
    """Tokens, merges and forced cuts of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        plain = {k: model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")}
        splitter = spec["pre_tokenizer"]
        if any(plain.values()) or model.get("ignore_merges") or spec["normalizer"]:
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        if splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or not splitter["use_regex"]:
            raise ValueError(f"unknown splitting in {path}")
        letters = byte_letters()
        as_bytes = {token: bytes(letters[c] for c in token) for token in model["vocab"]}
        self.size = 1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.tokens = [b""] * self.size
        for token, number in model["vocab"].items():
            self.tokens[number] = as_bytes[token]
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = model["vocab"][letter]
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            whole = (model["vocab"][left], model["vocab"][right])
            merges.setdefault(whole, (rank, model["vocab"][left + right]))
        self.merger = PairMerger(merges, self.size)
        self.joined = np.zeros(1 << 16, bool)  # byte pairs met inside some token
        for token in as_bytes.values():
            for a, b in zip(token, token[1:], strict=False):
                self.joined[a << 8 | b] = True
        self.added = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"unknown kind of added token in {path}")
            self.added[token["content"]] = token["id"]
            self.tokens[token["id"]] = token["content"].encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile(f"({'|'.join(map(re.escape, longest_first)) or '(?!)'})")
        self.classes = character_classes()


class Encoder:
    """Encodes texts; lives in one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.letters = np.array(vocabulary.byte_ids, np.int32)
        self.memory = Remembered(REMEMBERED)

    def _learn(self, fragments: Iterator[bytes]) -> None:
        """Merges the fragments that are new, all at once, and remembers their ids as little-endian 32-bit integers."""
        new = self.memory.unknown(fragments)
        if not new:
            return
        symbols = self.letters[np.frombuffer(b"".join(new), np.uint8)]
        merged, sizes = self.v.merger.merge(symbols, np.fromiter(map(len, new), np.int64, len(new)))
        packed, ends = merged.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        ids = (packed[a:b] for a, b in zip([0, *ends], ends, strict=False))
        self.memory.now.update(zip(new, ids, strict=True))

    def boundaries(self, points: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Where the pattern begins a match, for texts that are each followed by a mark of class END.

        The pattern takes runs of one class, a single space with the run that follows it, all white
        space but its last character otherwise, and endings such as 's by themselves.
        """
        n = len(points)
        begins = np.ones(n, bool)
        begins[1:] = classes[1:] != classes[:-1]
        begins[1:] |= classes[:-1] == END
        last_white = np.flatnonzero((classes[:-1] == SPACE) & (classes[1:] != SPACE) & (classes[1:] != END))
        begins[last_white] = True
        begins[last_white[points[last_white] == 0x20] + 1] = False

        marks = np.flatnonzero(points == 0x27)
        marks = marks[marks + 1 < n]
        free = np.ones(len(marks), bool)
        inner = marks > 0
        before = marks[inner] - 1
        free[inner] = (classes[before] != OTHER) & (points[before] != 0x20)
        marks = marks[free & (classes[marks + 1] == LETTER)]
        for ending in ENDINGS:
            fits = np.ones(len(marks), bool)
            for k, letter in enumerate(ending, 1):
                at = np.minimum(marks + k, n - 1)
                fits &= points[at] == ord(letter)
            hit = marks[fits]
            begins[hit + 1] = False
            ends = hit + 1 + len(ending)
            begins[ends[ends < n]] = True
            marks = marks[~fits]
        return begins

    def fragments(self, pieces: list[str]) -> Iterator[list[bytes]]:
        """The fragments of each piece."""
        whole = "\0".join(pieces) + "\0"
        data = whole.encode()
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in pieces), np.int64, len(pieces))) - 1
        classes = self.v.classes[points]
        classes[ends] = END
        begins = self.boundaries(points, classes)
        if len(data) == len(points):
            cuts, end_bytes = begins, ends
        else:
            width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
            place = np.cumsum(width) - width
            cuts, end_bytes = np.zeros(len(data), bool), place[ends]
            cuts[place[begins]] = True
        raw = np.frombuffer(data, np.uint8).astype(np.uint16)
        cuts[1:] |= ~self.v.joined[raw[:-1] << 8 | raw[1:]]
        cuts[end_bytes] = True
        cuts[end_bytes[:-1] + 1] = True
        starts = np.flatnonzero(cuts)
        marks = np.searchsorted(starts, end_bytes).tolist()
        spots = [*starts.tolist(), len(data)]
        found = [data[a:b] for a, b in zip(spots, spots[1:], strict=False)]
        begin = 0
        for mark in marks:
            yield found[begin:mark]
            begin = mark + 1

    def pieces(self, text: str) -> Iterator[str | int]:
        """Added tokens as their ids; the text between them, long runs cut where a match surely ends."""
        for part in self.v.added_pattern.split(text):
            if part in self.v.added:
                yield self.v.added[part]
            else:
                yield from self._cut(part)

    def _cut(self, text: str) -> Iterator[str]:
        begin = 0
        while len(text) - begin > CHUNK_CHARS:
            at = begin + CHUNK_CHARS
            # A space after something else always begins a match.
            while (at := text.find(" ", at)) >= 0 and text[at - 1].isspace():
                at += 1
            if at < 0:
                break
            yield text[begin:at]
            begin = at
        if begin < len(text):
            yield text[begin:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        todo: list[tuple[int, int, str]] = []
        chars = 0

        def flush() -> None:
            nonlocal chars
            parts = list(self.fragments([t for *_, t in todo]))
            self._learn(chain.from_iterable(parts))
            get = self.memory.now.__getitem__
            for (owner, place, _), found in zip(todo, parts, strict=True):
                out[owner][place] = b"".join(map(get, found))
            todo.clear()
            chars = 0

        for owner, text in enumerate(texts):
            for piece in self.pieces(text):
                if isinstance(piece, int):
                    out[owner].append(struct.pack("<I", piece))
                    continue
                out[owner].append(b"")
                todo.append((owner, len(out[owner]) - 1, piece))
                chars += len(piece)
                if chars >= CHUNK_CHARS:
                    flush()
        if todo:
            flush()
        return [b"".join(parts) for parts in out]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, as the library decodes them: bytes that are no UTF-8 are replaced."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.v.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ids (the token ids), decoded (their text).

    Null text counts as empty and gives no ids; ids may be null or repeat; texts of any length are
    encoded whole; an empty table gives no rows. Other columns are not read. `path` is a vocabulary
    file, read on the driver.
    """

    def lists(encoder: Encoder, ids: pa.Array, packed: list[bytes]) -> list[pa.Array]:
        sizes = np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed))
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
        decoded = pa.array([encoder.decode(p) for p in packed], pa.string())
        return [ids, pa.ListArray.from_arrays(pa.array(offsets), values), decoded]

    return _encoded(docs, path, id, text, lists, {"ids": "array<int>", "decoded": "string"})


def encoding_digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256; see encode_documents.

    Ids and texts are digested where they are made, so they need not leave the task.
    """

    def digests(encoder: Encoder, ids: pa.Array, packed: list[bytes]) -> list[pa.Array]:
        sums = [hashlib.sha256(p).hexdigest() for p in packed]
        texts = [hashlib.sha256(encoder.decode(p).encode()).hexdigest() for p in packed]
        counts = pa.array([len(p) // 4 for p in packed], pa.int64())
        return [ids, counts, pa.array(sums, pa.string()), pa.array(texts, pa.string())]

    kinds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return _encoded(docs, path, id, text, digests, kinds)


def _encoded(docs: DataFrame, path: str, id: str, text: str, columns_of, kinds: dict[str, str]) -> DataFrame:
    """Encodes every text and returns its id and what `columns_of` makes of the packed token ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    kinds = {"id": docs.schema[id].dataType.simpleString()} | kinds

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in small_batches(batch, 1):
                packed = encoder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(columns_of(encoder, part.column(0), packed), list(kinds))

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return to_python(rows).mapInArrow(encode, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))


def small_batches(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes in a string column, so that buffers stay bounded.

    What the work on a batch has freed goes back to the system after it: Python workers outlive
    their tasks, and an executor's memory holds all of them.
    """
    sizes = np.fromiter((len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column(column)), np.int64, batch.num_rows)
    piece = np.cumsum(sizes) // most
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(piece, piece[begin], "right"))
        yield batch.slice(begin, end - begin)
        begin = end
    give_back()


def give_back() -> None:
    """Hands memory that is free inside this process back to the system, where that can be asked for."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
