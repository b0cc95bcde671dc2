"""Removed bytes against brute force."""

import random

import numpy as np
import pytest

from gainledger.llm.repeat_anchors import LENGTH, anchors, begins_of, column_wise, contexts, covered
from gainledger.llm.suffix_dedup import remove_repeats


def brute(rows):
    """{id: (spans, kept)} of rows with different ids."""
    first, out = {}, {}
    for id, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - LENGTH + 1):
            if first.setdefault(data[i : i + LENGTH], id) < id:
                gone[i : i + LENGTH] = True
        change = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[id] = (list(zip(change[::2].tolist(), change[1::2].tolist(), strict=True)), kept)
    return out


def removed(docs, work, **more):
    rows = remove_repeats(docs, work, **more).collect()
    return {r.id: (list(zip(r.begins, r.ends, strict=True)), bytes(r.kept)) for r in rows}


def corpus(seed):
    pick = random.Random(seed)
    letters = "abcdé "
    make = lambda n: "".join(pick.choice(letters) for _ in range(n))
    passages = [make(pick.choice([49, 50, 51, 90, 300])) for _ in range(8)]
    texts = []
    for _ in range(120):
        parts = [make(pick.randrange(80)) for _ in range(pick.randrange(4))]
        parts += [pick.choice(passages) for _ in range(pick.randrange(3))]
        pick.shuffle(parts)
        texts.append("".join(parts))
    texts += texts[:15] + [t[:-3] for t in texts[20:40]] + ["x" * n for n in (49, 50, 51, 400, 400)]
    texts += ["ab" * 100, "ab" * 60 + make(30), make(20) + "ba" * 70]
    ids = list(range(len(texts)))
    pick.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(documents, work, seed):
    rows = corpus(seed)
    assert removed(documents(*rows), work) == brute(rows)


def test_crowded_anchors_are_compared_string_by_string(documents, work):
    rows = corpus(4)
    assert removed(documents(*rows), work, most_of_anchor=2) == brute(rows)


def test_null_empty_short_repeated_rows_and_null_ids(documents, work):
    text = "0123456789" * 6
    docs = documents((1, None), (2, ""), (3, text[:49]), (4, text[:49]), (5, text), (5, text), (None, text), (None, "z" * 60))
    rows = sorted(((r.id, r.n_bytes, r.begins, r.ends) for r in remove_repeats(docs, work).collect()), key=str)
    wanted = [
        (1, 0, [], []), (2, 0, [], []), (3, 49, [], []), (4, 49, [], []),
        (5, 60, [], []), (5, 60, [], []), (None, 60, [0], [60]), (None, 60, [], []),
    ]
    assert rows == sorted(wanted, key=str)
    assert remove_repeats(documents().limit(0), type(work)(work.spark)).count() == 0


def test_every_window_holds_an_anchor():
    pick = random.Random(0)
    texts = [bytes(pick.choice(b"abc") for _ in range(pick.randrange(300))) for _ in range(40)] + [b"x" * 200, b""]
    _, text, position = anchors(texts)
    found = set(zip(text.tolist(), position.tolist(), strict=True))
    for i, t in enumerate(texts):
        for begin in range(len(t) - LENGTH + 1):
            assert any((i, begin + k) in found for k in range(LENGTH - 15))


def test_column_wise_construction():
    pick = random.Random(5)
    base = bytes(pick.choice(b"ab") for _ in range(150))
    texts = [base, base[3:140], b"c" + base[10:] + b"d", base[:80] + b"e" + base[81:], b"q" * 120, b"q" * 70]
    hashed, text, position = anchors(texts)
    order = np.argsort(hashed, kind="stable")
    hashed, text, position = hashed[order], text[order], position[order]
    group = np.cumsum(np.concatenate([[0], hashed[1:] != hashed[:-1]]))
    matrix, first, last = contexts(texts, text, position)
    mask = column_wise(matrix, group, first, last, text)
    wanted = brute([(i, t.decode()) for i, t in enumerate(texts)])
    for i, t in enumerate(texts):
        gone = covered(begins_of(position[text == i], mask[text == i], len(t)), len(t))
        assert bytes(np.frombuffer(t, np.uint8)[~gone]) == wanted[i][1]


def test_texts_that_share_a_number_are_told_apart(documents, work, monkeypatch):
    monkeypatch.setattr("gainledger.llm.suffix_dedup.NUMBER_DIGITS", 1)
    rows = corpus(6)
    assert removed(documents(*rows), work) == brute(rows)
