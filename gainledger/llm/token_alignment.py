"""Alignment of two tokenizers over the same bytes, and how common each link is in the corpus.

Both tokenizers spell the bytes of a text, so the ends of their tokens are two sorted lists over one
axis. They are merged by merge paths (see merge_path): overlaps of tokens are links, common ends close
groups. Links are counted in documents over the whole corpus, and every document is told how many of
its links are the most common ones of their token.

Documents are aligned in chunks of bounded size. A chunk lists its different links once, so that the
corpus counts go to chunks, not to documents: documents refer to places in their chunk's list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .bpe import Encoder, Vocabulary, small_batches
from .common import to_python
from .merge_path import align
from .pair_merging import Remembered
from .piece_encode import PieceEncoder, PieceVocabulary

# Fragments that the byte-level encoder remembers, and bytes of text in a chunk.
REMEMBERED = 300_000
CHUNK_BYTES = 16 << 20

# Fixed values of the groups' notation: what follows a token.
SAME_SIDE, OTHER_SIDE, NEXT_GROUP, TEXT_END = range(4)
AFTER = [",", "|", ";", ""]

DIGESTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class PlainEncoder(Encoder):
    """A byte-level encoder to which the strings of special tokens are plain text."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.memory = Remembered(REMEMBERED)

    def pieces(self, text: str) -> Iterator[str]:
        yield from self._cut(text)


@dataclass
class Vocabularies:
    """What both sides need in a task; made on the driver."""

    a: Vocabulary
    b: PieceVocabulary

    @classmethod
    def read(cls, path_a: str, path_b: str) -> Vocabularies:
        return cls(Vocabulary(path_a), PieceVocabulary(path_b))


@dataclass
class Aligned:
    """Aligned documents: counts and group digest of each, and the ids of all links in their order."""

    digests: list[tuple[int, int, int, int, str]]
    owner: np.ndarray  # document of each link
    left: np.ndarray  # id of A's token
    right: np.ndarray  # id of B's token


class Aligner:
    """Encodes and aligns texts; lives in one task."""

    def __init__(self, v: Vocabularies):
        self.a, self.b = PlainEncoder(v.a), PieceEncoder(v.b)
        self.bytes_a, self.bytes_b = v.a.tokens, v.b.token_bytes
        self.width_a = np.array([len(t) for t in self.bytes_a])
        self.width_b = np.array([len(t) for t in self.bytes_b])
        self.names = [f"{i}{after}" for after in AFTER for i in range(self.ids)]

    @property
    def ids(self) -> int:
        """More than any id of both sides."""
        return max(len(self.bytes_a), len(self.bytes_b))

    def align(self, texts: list[str]) -> Aligned:
        """Texts that are empty, or whose tokens do not spell space + text, have no tokens."""
        spaced = [f" {text}" for text in texts]
        a = [np.frombuffer(packed, "<u4") for packed in self.a.encode(spaced)]
        b = [found.ids for found in self.b.encode(texts)]
        for k, text in enumerate(spaced):
            if len(text) == 1 or not self._spells(text.encode("utf-8", "surrogatepass"), a[k], b[k]):
                a[k] = b[k] = np.zeros(0, np.int32)
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b))
        a, b = (np.concatenate([np.zeros(0, np.int64), *side]).astype(np.int64) for side in (a, b))
        found = align(np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b]))
        owner = np.repeat(np.arange(len(texts)), n_a)[found.left]
        n_links = np.bincount(owner, minlength=len(texts))
        n_groups = np.bincount(owner[found.closes], minlength=len(texts))
        sums = self._group_digests(a, b, n_a + n_b, found)
        counts = (n.tolist() for n in (n_a, n_b, n_groups, n_links))
        return Aligned([*zip(*counts, sums, strict=True)], owner, a[found.left], b[found.right])

    def _spells(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        sides = (self.bytes_a, a), (self.bytes_b, b)
        return all(text == b"".join(map(tokens.__getitem__, ids.tolist())) for tokens, ids in sides)

    def _group_digests(self, a: np.ndarray, b: np.ndarray, tokens: np.ndarray, found) -> list[str]:
        """Hashes of the groups of each document, which has so many tokens of both sides."""
        group = np.cumsum(found.closes) - found.closes
        of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        of_a[found.left], of_b[found.right] = group, group
        groups = int(group[-1]) + 1 if len(group) else 0
        size_a, size_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        until_a, until_b = np.cumsum(size_a), np.cumsum(size_b)
        after_a, after_b = np.full(len(a), SAME_SIDE), np.full(len(b), SAME_SIDE)
        after_a[until_a - 1], after_b[until_b - 1] = OTHER_SIDE, NEXT_GROUP
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + (until_b - size_b)[of_a]] = a + self.ids * after_a
        names[np.arange(len(b)) + until_a[of_b]] = b + self.ids * after_b
        ends = np.cumsum(tokens)
        last = ends[tokens > 0] - 1
        names[last] += self.ids * (TEXT_END - NEXT_GROUP)
        listed, sums = names.tolist(), []
        for begin, end in zip((ends - tokens).tolist(), ends.tolist(), strict=True):
            text = "".join(map(self.names.__getitem__, listed[begin:end]))
            sums.append(hashlib.sha256(text.encode()).hexdigest() if end > begin else "")
        return sums


def _planes(values: np.ndarray) -> bytes:
    """Small integers byte by byte, all lowest bytes first, as they compress best."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


@dataclass
class Chunk:
    """Aligned documents that share one list of links."""

    number: int
    ids: list = field(default_factory=list)
    digests: list = field(default_factory=list)
    sizes: list = field(default_factory=list)  # different links of each document
    links: list = field(default_factory=list)
    times: list = field(default_factory=list)
    bytes: int = 0

    def add(self, ids: list, found: Aligned, base: int, size: int) -> None:
        """Takes the documents of a batch; each link becomes left * base + right."""
        self.bytes += size
        self.ids += ids
        self.digests += found.digests
        every = np.int64(base) * base
        keys = np.sort(found.owner * every + found.left * base + found.right)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.times.append(np.diff(first, append=len(keys)))
        owner, link = np.divmod(keys[first], every)
        self.links.append(link)
        self.sizes.append(np.bincount(owner, minlength=len(ids)))

    def rows(self, kind: pa.DataType) -> pa.RecordBatch:
        """A row for each document and, last, one that lists the links with the documents that hold them."""
        links, times, sizes = (np.concatenate(x) for x in (self.links, self.times, self.sizes))
        listed = np.unique(links)
        places = np.searchsorted(listed, links)
        holders = np.bincount(places, minlength=len(listed))
        gaps = np.diff(places, prepend=0)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        heads = begins[sizes > 0]
        gaps[heads] = places[heads]
        spots = [*zip(begins.tolist(), ends.tolist(), strict=True)]
        n = len(self.ids)
        columns = [
            pa.array([self.number] * (n + 1), pa.int64()),
            pa.array([*self.ids, None], kind),
            *(pa.array([*column, None], t) for column, t in zip(zip(*self.digests, strict=True), DIGEST_TYPES, strict=True)),
            pa.array([*(_planes(gaps[a:b]) for a, b in spots), None], pa.binary()),
            pa.array([*(_planes(times[a:b]) for a, b in spots), None], pa.binary()),
            pa.array([*[None] * n, listed], pa.list_(pa.int64())),
            pa.array([*[None] * n, holders], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, CHUNK_COLUMNS)


DIGEST_TYPES = [pa.int64()] * 4 + [pa.string()]
CHUNK_COLUMNS = [
    "chunk", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "links", "holders",
]
CHUNKS = f"chunk long, id {{id}}, {DIGESTS}, places binary, times binary, links array<long>, holders array<long>"


def align_tokens(
    docs: DataFrame, work: Workspace, path_a: str, path_b: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `path_a` is a byte-level vocabulary, which encodes space + text, and `path_b` a model of pieces,
    which puts the space in front itself; both are read on the driver. A link is a pair of tokens
    whose bytes overlap; its count is the number of rows that hold this pair of ids linked. `n_best`
    counts the links whose count is the highest of their A id, ties included; `count_sum` adds up the
    counts of all links. Groups end where tokens of both sides end.

    Null and empty texts, and texts whose tokens do not spell them, have no tokens: zeros and an empty
    digest. Ids may be null or repeat, every row is a document of its own; texts of any length are
    aligned whole; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabularies.read(path_a, path_b))
    base = max(shared.value.a.size, shared.value.b.size)
    kind = docs.schema[id].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared.value)
        number = TaskContext.get().partitionId() << 32
        now, id_kind = Chunk(number), pa.int64()
        for batch in batches:
            id_kind = batch.column(0).type
            for part in small_batches(batch, 1):
                now.add(part.column(0).to_pylist(), aligner.align(part.column(1).to_pylist()), base, part.nbytes)
                if now.bytes >= CHUNK_BYTES:
                    yield now.rows(id_kind)
                    now = Chunk(now.number + 1)
        if now.ids:
            yield now.rows(id_kind)

    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    stored = work.store(to_python(rows).mapInArrow(chunks, CHUNKS.format(id=kind)), "aligned_chunks")

    listed = stored.filter("links is not null").select(
        F.col("chunk").alias("lister"), F.posexplode(F.arrays_zip("links", "holders")).alias("place", "link")
    )
    listed = listed.select("lister", "place", F.col("link.links").alias("link"), F.col("link.holders").alias("holders"))
    # At most one row for each id of B in a window.
    of_a = Window.partitionBy(F.expr(f"link div {base}"))
    counts = listed.groupBy("link").agg(F.sum("holders").alias("n"))
    counts = counts.select("link", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))
    known = listed.select("lister", "place", "link").join(counts, "link").select("lister", "place", "n", "best")

    def weigh(docs: pa.Table, known: pa.Table) -> pa.Table:
        n, best = np.zeros(known.num_rows, np.int64), np.zeros(known.num_rows, bool)
        places = known["place"].to_numpy()
        n[places], best[places] = known["n"].to_numpy(), known["best"].to_numpy()
        n_best, count_sum = [], []
        for steps, times in zip(docs["places"], docs["times"], strict=True):
            at, times = np.cumsum(_from_planes(steps.as_py())), _from_planes(times.as_py())
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * n[at]).sum()))
        kept = docs.select(["id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
        kept = kept.append_column("count_sum", pa.array(count_sum, pa.int64()))
        return kept.append_column("groups_sha256", docs["groups_sha256"])

    documents = stored.filter("links is null").drop("links", "holders")
    both = documents.groupBy("chunk").cogroup(known.groupBy("lister"))
    counted = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return both.applyInArrow(weigh, f"id {kind}, {counted}")
