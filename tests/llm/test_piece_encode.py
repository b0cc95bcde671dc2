"""Pieces, spans and decoded texts against the sentencepiece library, also under other character maps."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from sentencepiece import sentencepiece_model_pb2 as model_format

import gainledger.llm.pair_merging as pair_merging
import gainledger.llm.piece_encode as piece_encode
from gainledger.llm.piece_encode import PieceEncoder, PieceVocabulary, encode_pieces, piece_digests

FILE = path("piece_bpe_32k.model")
PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "é", "1", "23", "!", "▁", "▁▁", "　", "日本", "😀", "\0", "<s>", "<unk>",
    "<0x41>", "the ", "The", "x" * 70, "\x85", "́", "한국", "ﷺ", "½", "\U000e0001", "ﬁ", "㎏ ", "ｱﾞ", "①", "Å",
    "¨", "​", "　 ", "\x01",
]


def texts_of(seed, n, parts=40):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randrange(parts))) for _ in range(n)]


def check(file, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    encoder = PieceEncoder(PieceVocabulary(file))
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        wanted = library.encode(text, return_type="proto").pieces
        assert found.ids.tolist() == [p.id for p in wanted], repr(text)
        spans = zip(found.begins.tolist(), found.ends.tolist(), strict=True)
        assert [*spans] == [(p.begin, p.end) for p in wanted], repr(text)
        assert encoder.decode(found.ids) == library.decode(found.ids.tolist()), repr(text)


def test_random_texts():
    check(FILE, texts_of(1, 3000))


def test_every_character_in_its_surroundings():
    check(FILE, [f" {c}{c}a {c}\n{c}" for c in map(chr, range(0x3000))])


def test_long_fragments_and_cut_texts(monkeypatch):
    texts = ["a" * 3000, "ab " * 2000 + "c", " " * 500 + "x", "", *texts_of(2, 300, 200)]
    check(FILE, texts)
    monkeypatch.setattr(piece_encode, "CHUNK_CHARS", 40)
    check(FILE, texts)
    monkeypatch.setattr(pair_merging, "LONG_FRAGMENT", 2)
    check(FILE, texts)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(piece_encode, "REMEMBERED", 3)
    monkeypatch.setattr(piece_encode, "CHUNK_CHARS", 10)
    check(FILE, ["one two three four five six seven one two"] * 3 + texts_of(3, 50))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_compiled_character_maps(tmp_path, monkeypatch, rule, squeeze):
    model = model_format.ModelProto()
    with open(FILE, "rb") as file:
        model.ParseFromString(file.read())
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    model.normalizer_spec.ParseFromString(spec)
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    model.normalizer_spec.add_dummy_prefix = model.normalizer_spec.escape_whitespaces = True
    file = tmp_path / "mapped.model"
    file.write_bytes(model.SerializeToString())
    texts = texts_of(4, 600) + [f" {c}{c}a {c}\n{c}" for c in map(chr, range(1, 0x3000, 5))]
    check(str(file), texts)
    monkeypatch.setattr(piece_encode, "CHUNK_CHARS", 40)
    check(str(file), texts[:600])


def test_bytes_that_are_no_text():
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    encoder = PieceEncoder(PieceVocabulary(FILE))
    pick = random.Random(5)
    for _ in range(300):
        ids = [pick.choice([*range(259), 264, 259, 29142]) for _ in range(12)]
        assert encoder.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_documents(documents):
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    rows = [(1, "Hello there, 日本"), (2, None), (2, ""), (None, "x y" * 50_000)]
    docs = documents(*rows)
    coded = {(r.id, r.decoded): r for r in encode_pieces(docs, FILE).collect()}
    for id, text in rows:
        found = coded[id, text or ""]
        wanted = library.encode(text or "", return_type="proto").pieces
        assert found.ids == [p.id for p in wanted]
        assert [*zip(found.begins, found.ends, strict=True)] == [(p.begin, p.end) for p in wanted]
    sums = {(r.id, r.n_tokens): r for r in piece_digests(docs, FILE).collect()}
    ids = library.encode("Hello there, 日本")
    found = sums[1, len(ids)]
    assert found.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found.decoded_sha256 == hashlib.sha256("Hello there, 日本".encode()).hexdigest()
    assert sums[2, 0].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert encode_pieces(documents().limit(0), FILE).count() == 0
