"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import gainledger.llm.bpe as bpe
from gainledger.llm.bpe import Encoder, Vocabulary, encode_documents, encoding_digests, small_batches
from gainledger.llm.pair_merging import PairMerger

FILE = path("byte_bpe_50k.json")
PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'", "''", "'re", "'ll", "'LL", "é", "ê", "1", "23", "!", "...", "　",
    "\x85", "\x1c", "\xa0", "日本", "😀", "\0", "<|endoftext|>", "<|", "x" * 60, "the ", "Ab", " '", "\r\n", "́", "²", "Ⅷ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary(FILE))


def check(encoder, library, texts):
    wanted = library.encode_batch(texts, add_special_tokens=False)
    for text, packed, want in zip(texts, encoder.encode(texts), wanted, strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == want.ids, repr(text)
        assert encoder.decode(packed) == library.decode(want.ids, skip_special_tokens=False)


def test_random_texts(encoder, library):
    pick = random.Random(1)
    check(encoder, library, ["".join(pick.choice(PARTS) for _ in range(pick.randrange(40))) for _ in range(5000)])


def test_every_character_in_its_surroundings(encoder, library):
    check(encoder, library, [f" {c}{c}a {c}\n{c}" for c in map(chr, range(0x3000)) if not 0xD800 <= ord(c) < 0xE000])


def test_long_fragments_and_cut_texts(encoder, library, monkeypatch):
    texts = ["a" * 3000, "ab" * 2000 + " c", "word  \n word " * 300, " " * 500 + "x", "", "Zürich's " * 200]
    check(encoder, library, texts)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    check(encoder, library, texts)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    check(Encoder(Vocabulary(FILE)), library, ["one two three four five six seven one two"])


def test_new_fragments_of_a_chunk_are_merged_at_once(library, monkeypatch):
    merge, calls = PairMerger.merge, []
    monkeypatch.setattr(PairMerger, "merge", lambda *a: calls.append(len(a[2])) or merge(*a))
    encoder = Encoder(Vocabulary(FILE))
    pick = random.Random(2)
    words = ["".join(pick.choices("aehinorst", k=pick.choice([3, 9, 47, 49, 63, 64, 65, 90]))) for _ in range(2000)]
    check(encoder, library, [" ".join(words), " ".join(words[::-1]), "a" * 64 + " " + "ab" * 33])
    assert len(calls) == 1 and calls[0] > 1900
    check(encoder, library, [" ".join(words)])
    assert len(calls) == 1


def test_documents(documents, library):
    rows = [(1, "Hello there"), (2, None), (2, ""), (None, "x" * 100_000)]
    docs = documents(*rows)
    coded = {(r.id, r.decoded): r.ids for r in encode_documents(docs, FILE).collect()}
    for id, text in rows:
        assert coded[id, text or ""] == library.encode(text or "", add_special_tokens=False).ids
    sums = {r.id: r for r in encoding_digests(docs, FILE).collect()}
    ids = library.encode("Hello there", add_special_tokens=False).ids
    assert sums[1].n_tokens == len(ids)
    assert sums[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert sums[1].decoded_sha256 == hashlib.sha256(b"Hello there").hexdigest()
    assert sums[2].n_tokens == 0
    assert encode_documents(documents().limit(0), FILE).count() == 0


def test_small_batches_keep_every_row():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "d" * 50, "e"])], ["t"])
    for most in (1, 3, 60, 1000):
        assert [x for b in small_batches(batch, 0, most) for x in b.column(0).to_pylist()] == batch.column(0).to_pylist()
