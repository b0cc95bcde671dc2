"""Encoding into the pieces of a sentencepiece model, with the span of source bytes of every piece.

Texts are normalised by the longest prefixes of the model's compiled character map, and every
character of the result remembers its place in the source. Where two neighbouring characters meet
inside no piece, a cut is certain; the fragments between cuts are merged (all new ones of a batch at
once) and remembered. The pieces' lengths add up to places in the normalised text, and those are
projected to source bytes through the alignment.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format

from .bpe import small_batches
from .character_map import MARK, Normaliser, code_points, utf8_width
from .common import to_python
from .pair_merging import PairMerger, Remembered

# Fixed values of the model format: the kinds of pieces, and of models.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2

CODES = 0x110000
# Places for pairs of neighbouring characters; two pairs in one place only mean fewer cuts.
PAIR_BITS = 22
# Characters encoded at once, and fragments remembered (and as many of the time before).
CHUNK_CHARS = 1 << 19
REMEMBERED = 300_000

# Bytes that are no UTF-8 decode to one replacement character each.
EACH_BYTE = "gainledger-each-byte"
codecs.register_error(EACH_BYTE, lambda e: ("\ufffd" * (e.end - e.start), e.end))


def _pair_place(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
    return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - PAIR_BITS)


class PieceVocabulary:
    """Pieces, merges, certain cuts and normalisation of a model file of the sentencepiece library."""

    def __init__(self, path: str):
        model = model_format.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer = model.trainer_spec
        if trainer.model_type != BPE or trainer.treat_whitespace_as_suffix:
            raise ValueError(f"not a plain byte-pair model: {path}")
        if {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"unknown kind of piece in {path}")
        self.normaliser = Normaliser(model.normalizer_spec)
        self.size = len(model.pieces)
        self.kinds = np.array([p.type for p in model.pieces])
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.strip_first = self.normaliser.prefix or self.normaliser.squeeze
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}

        # A character is the piece of its own, or a symbol beyond all pieces.
        self.symbol_of = np.arange(self.size, self.size + CODES, dtype=np.int32)
        for piece, number in normal.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = number

        def symbol(part: str) -> int | None:
            return normal.get(part) if len(part) > 1 else int(self.symbol_of[ord(part)])

        ranks = {s: r for r, s in enumerate(sorted({model.pieces[i].score for i in normal.values()}, reverse=True))}
        pairs = {}
        self.joined = np.zeros(1 << PAIR_BITS, bool)  # characters met side by side in some piece
        for piece, number in normal.items():
            points = code_points(piece)
            self.joined[_pair_place(points[:-1], points[1:])] = True
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = (ranks[model.pieces[number].score], number)
        self.merger = PairMerger(pairs, self.size + CODES)
        marks_lead = all(chr(MARK) not in p.lstrip(chr(MARK)) for p in normal)
        self.cuts_at_spaces = marks_lead and self.normaliser.map.cuts_at_spaces

        self.bytes_as = np.full(256, self.unknown, np.int32)
        self.byte_of = np.full(self.size, -1, np.int64)
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_of[i] = int(p.piece[3:-1], 16)
                self.bytes_as[self.byte_of[i]] = i
        self.byte_fallback = trainer.byte_fallback
        # Characters of normal pieces; the bytes each piece stands for, marks as spaces.
        self.chars = np.array([len(p.piece) if p.type == NORMAL else 0 for p in model.pieces])
        self.chars[self.unknown] = 1
        self.token_bytes = [
            bytes([self.byte_of[i]]) if p.type == BYTE
            else p.piece.replace(chr(MARK), " ").encode() if p.type == NORMAL
            else trainer.unk_surface.encode() if p.type == UNKNOWN
            else b""
            for i, p in enumerate(model.pieces)
        ]


@dataclass
class Encoded:
    """Pieces of one text: their ids, and the source bytes [begin, end) of each."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class PieceEncoder:
    """Encodes texts; lives in one task."""

    def __init__(self, vocabulary: PieceVocabulary):
        self.v = vocabulary
        self.memory = Remembered(REMEMBERED)

    def _learn(self, fragments: list[str]) -> None:
        """Merges the fragments that are new, all at once, and remembers their ids packed."""
        new = self.memory.unknown(fragments)
        if not new:
            return
        v = self.v
        symbols = v.symbol_of[code_points("".join(new))]
        merged, sizes = v.merger.merge(symbols, np.fromiter(map(len, new), np.int64, len(new)))
        unknown = merged >= v.size
        if unknown.any():
            points = (merged - v.size)[unknown]
            if v.byte_fallback:
                spelt = np.frombuffer("".join(map(chr, points.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
                parts = np.ones(len(merged), np.int64)
                parts[unknown] = utf8_width(points)
                inside = np.repeat(unknown, parts)
                owner = np.repeat(np.repeat(np.arange(len(new)), sizes), parts)
                merged = np.repeat(merged, parts)
                merged[inside] = v.bytes_as[spelt]
                sizes = np.bincount(owner, minlength=len(new))
            else:
                merged[unknown] = v.unknown
        packed = merged.astype("<i4").tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        self.memory.now.update(zip(new, [packed[a:b] for a, b in pairwise([0, *ends])], strict=True))

    def _pieces(self, text: str) -> Iterator[tuple[str, int, bool, bool]]:
        """Parts of a text with their first byte; long texts are cut where a piece surely begins.

        That is before a space which follows a plain letter or digit, as long as the map does not look
        across spaces and no piece holds a mark behind another character.
        """
        begin = place = 0
        while self.v.cuts_at_spaces and len(text) - begin > CHUNK_CHARS:
            at = begin + CHUNK_CHARS
            while (at := text.find(" ", at)) >= 0 and not (text[at - 1].isascii() and text[at - 1].isalnum()):
                at += 1
            if at < 0:
                break
            yield text[begin:at], place, begin == 0, False
            place += len(text[begin:at].encode("utf-8", "surrogatepass"))
            begin = at
        yield text[begin:], place, begin == 0, True

    def encode(self, texts: list[str]) -> list[Encoded]:
        """Pieces and spans of each text."""
        out: list[list[Encoded]] = [[] for _ in texts]
        todo: list[tuple[int, str, int, bool, bool]] = []
        chars = 0
        for owner, text in enumerate(texts):
            for piece, place, first, last in self._pieces(text):
                todo.append((owner, piece, place, first, last))
                chars += len(piece)
                if chars >= CHUNK_CHARS:
                    self._flush(todo, out)
                    todo, chars = [], 0
        self._flush(todo, out)
        return [
            parts[0] if len(parts) == 1 else Encoded(*(np.concatenate([getattr(p, f) for p in parts]) for f in FIELDS))
            for parts in out
        ]

    def _flush(self, todo: list[tuple[int, str, int, bool, bool]], out: list[list[Encoded]]) -> None:
        if not todo:
            return
        v = self.v
        normal = [v.normaliser.apply(text, first, last) for _, text, _, first, last in todo]
        points = np.concatenate([p for p, _ in normal])
        ends = np.cumsum([len(p) for p, _ in normal])
        cuts = np.ones(len(points) + 1, bool)
        cuts[1:-1] = ~v.joined[_pair_place(points[:-1], points[1:])]
        cuts[ends] = True
        spots = np.flatnonzero(cuts)
        whole = points.tobytes().decode("utf-32-le", "surrogatepass")
        fragments = [whole[a:b] for a, b in pairwise(spots.tolist())]
        self._learn(fragments)
        packed = list(map(self.memory.now.__getitem__, fragments))
        marks = np.searchsorted(spots, ends).tolist()
        for (owner, _, place, _, _), (_, source), (a, b) in zip(todo, normal, pairwise([0, *marks]), strict=True):
            ids = np.frombuffer(b"".join(packed[a:b]), "<i4")
            begins, until = self._spans(ids, source)
            out[owner].append(Encoded(ids, begins + place, until + place))

    def _spans(self, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Projects pieces to the source: `source` holds the place of every normalised character.

        Of the byte pieces that spell one character the last has its span, the others are empty.
        """
        chars = self.v.chars[ids]
        spelt = self.v.byte_of[ids]
        heads = np.flatnonzero((spelt >= 0) & (spelt & 0xC0 != 0x80))
        if len(heads):
            head = spelt[heads]
            chars[heads + (head >= 0xC0) + (head >= 0xE0) + (head >= 0xF0)] = 1
        after = np.cumsum(chars)
        begins = source[after - chars]
        return begins, np.where(chars == 0, begins, source[after])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library decodes them."""
        v = self.v
        head, k = b"", 0
        while k < len(ids) and not head:  # the mark that normalisation put in front goes
            head = v.token_bytes[ids[k]]
            marked = v.strip_first and bool(v.kinds[ids[k]] == NORMAL) and head[:1] == b" "
            head, k = head[marked:], k + 1
            if marked and not v.normaliser.squeeze:
                break
        raw = head + b"".join(map(v.token_bytes.__getitem__, ids[k:].tolist()))
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", EACH_BYTE)


FIELDS = ("ids", "begins", "ends")


def encode_pieces(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ids (of the pieces), begins and ends (the source bytes of each), decoded.

    Null text counts as empty and gives no pieces; ids may be null or repeat; texts of any length are
    encoded whole; an empty table gives no rows. Other columns are not read. `path` is a model file,
    read on the driver.
    """

    def lists(encoder: PieceEncoder, ids: pa.Array, found: list[Encoded]) -> list[pa.Array]:
        offsets = pa.array(np.cumsum([0, *(len(e.ids) for e in found)]), pa.int32())
        flat = [np.concatenate([getattr(e, f) for e in found]).astype(np.int32) for f in FIELDS]
        decoded = pa.array([encoder.decode(e.ids) for e in found], pa.string())
        return [ids, *(pa.ListArray.from_arrays(offsets, pa.array(f)) for f in flat), decoded]

    kinds = {"ids": "array<int>", "begins": "array<int>", "ends": "array<int>", "decoded": "string"}
    return _encoded(docs, path, id, text, lists, kinds)


def piece_digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256, spans_sha256; see encode_pieces.

    Ids are hashed as decimals joined by commas, spans as little-endian 64-bit integers, all begins
    before all ends; all of it is digested where it is made.
    """

    def digests(encoder: PieceEncoder, ids: pa.Array, found: list[Encoded]) -> list[pa.Array]:
        names = [str(i) for i in range(encoder.v.size)]
        texts = [",".join(map(names.__getitem__, e.ids.tolist())).encode() for e in found]
        decoded = [encoder.decode(e.ids).encode("utf-8", "surrogatepass") for e in found]
        spans = [np.concatenate([e.begins, e.ends]).astype("<i8").tobytes() for e in found]
        hashes = [pa.array([hashlib.sha256(x).hexdigest() for x in column]) for column in (texts, decoded, spans)]
        return [ids, pa.array([len(e.ids) for e in found], pa.int64()), *hashes]

    kinds = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "spans_sha256": "string"}
    return _encoded(docs, path, id, text, digests, kinds)


def _encoded(docs: DataFrame, path: str, id: str, text: str, columns_of, kinds: dict[str, str]) -> DataFrame:
    """Encodes every text and returns its id and what `columns_of` makes of its pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(PieceVocabulary(path))
    kinds = {"id": docs.schema[id].dataType.simpleString()} | kinds

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(shared.value)
        for batch in batches:
            for part in small_batches(batch, 1):
                found = encoder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(columns_of(encoder, part.column(0), found), list(kinds))

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return to_python(rows).mapInArrow(encode, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))
