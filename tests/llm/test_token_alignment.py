"""Alignment of two tokenizers against the libraries and a plain pairwise version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

import gainledger.llm.token_alignment as token_alignment
from gainledger.llm.bpe import byte_letters
from gainledger.llm.merge_path import align, split_points
from gainledger.llm.token_alignment import align_tokens

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
PARTS = [
    "a", "the ", " of", "tokenizer", "  ", "\n", "é", "1", "23", "!", "日本", "😀", "\0", "<s>", "<|endoftext|>",
    "<0x41>", "x" * 70, "\x85", "'s", "한국", "½", "Ungeheuer",
]


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 1000])
def test_pieces_of_a_merge_are_the_merge(steps):
    pick = random.Random(steps)
    for _ in range(200):
        end = pick.randrange(1, 60)
        a, b = (sorted({*pick.sample(range(1, end + 1), pick.randrange(end)), end}) for _ in range(2))
        begins = {tuple(x): [0, *x[:-1]] for x in (a, b)}
        links = [
            (i, j)
            for i in range(len(a))
            for j in range(len(b))
            if max(begins[tuple(a)][i], begins[tuple(b)][j]) < min(a[i], b[j])
        ]
        found = align(np.array(a), np.array(b), steps)
        assert [*zip(found.left.tolist(), found.right.tolist(), strict=True)] == links
        assert found.closes.tolist() == [a[i] == b[j] for i, j in links]


def test_split_points_halve_the_work():
    a, b = np.arange(0, 1000, 2), np.arange(0, 3000, 3)
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    diagonals = np.arange(0, len(merged) + 1, 50)
    assert split_points(a, b, diagonals).tolist() == [sum(side == 0 for _, side in merged[:d]) for d in diagonals]


def brute(texts):
    """Every document's row, without its id."""
    library_a, library_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library_a.encode_special_tokens = True
    letters = byte_letters()
    rows, held = [], Counter()
    for text in texts:
        a = library_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library_b.encode(text) if text else []
        as_a = [bytes(letters[c] for c in library_a.id_to_token(i)) for i in a]
        as_b = [
            bytes([int(p[3:-1], 16)]) if library_b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, library_b.id_to_piece(i)) for i in b)
        ]
        if not text or {b"".join(as_a), b"".join(as_b)} != {(" " + text).encode()}:
            rows.append(([], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([*map(len, as_a)]).tolist(), np.cumsum([*map(len, as_b)]).tolist()
        links, groups, i, j = [], [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            to_i, to_j = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:to_i])) + "|" + ",".join(map(str, b[j:to_j])))
            for k in range(i, to_i):
                for m in range(j, to_j):
                    if max(ends_a[k] - len(as_a[k]), ends_b[m] - len(as_b[m])) < min(ends_a[k], ends_b[m]):
                        links.append((a[k], b[m]))
            i, j = to_i, to_j
        rows.append((a, b, links, ";".join(groups)))
        held.update(set(links))
    highest = {}
    for (left, _), n in held.items():
        highest[left] = max(n, highest.get(left, 0))
    return [
        (
            len(a), len(b), groups.count(";") + 1 if groups else 0, len(links),
            sum(held[link] == highest[link[0]] for link in links), sum(held[link] for link in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for a, b, links, groups in rows
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("chunk", [1, 200, 1 << 24])
def test_documents(documents, work, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    pick = random.Random(3)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randrange(30))) for _ in range(120)]
    texts += ["", None, "a ▁ b", " ", "the the the", "the the the", "z" * 5000, "a b " * 2000]
    rows = [*enumerate(texts[:-1]), (None, texts[-1])]
    rows[3] = (2, rows[3][1])
    found = align_tokens(documents(*rows), work, A, B).select("id", *COLUMNS).collect()
    wanted = [(id, *row) for (id, _), row in zip(rows, brute([t or "" for t in texts]), strict=True)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_no_documents(documents, work):
    assert align_tokens(documents().limit(0), work, A, B).count() == 0


def test_test_data(spark, folder, work):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    rows = docs.select("doc_id", "text").collect()
    found = {r.id: tuple(r)[1:] for r in align_tokens(spark.createDataFrame(rows), work, A, B).collect()}
    assert found == {r.doc_id: row for r, row in zip(rows, brute([r.text or "" for r in rows]), strict=True)}
