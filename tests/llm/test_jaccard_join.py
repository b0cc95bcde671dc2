"""Groups of near copies against brute force."""

import random
import re

import numpy as np
import pytest

import gainledger.llm.jaccard_join as join
from gainledger.llm.jaccard_join import drop_near_copies, hashed_words, jaccard_groups, may_meet, shingle_sets
from tests.llm.test_near_vectors import groups_of


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    group = groups_of(len(rows), links)
    least = {}
    for i, (id, _) in enumerate(rows):
        least[group[i]] = min(least.get(group[i], id), id)
    return {id: (len(sets[i]), least[group[i]]) for i, (id, _) in enumerate(rows)}


def corpus(seed, n=250):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 3, 4, 5, 6, 20, 60, 120]))) for _ in range(n)]
    base = " ".join(pick.choice(words) for _ in range(100))
    for _ in range(80):  # a large group of near copies, each with few changes
        part = base.split()
        for _ in range(pick.randrange(4)):
            part[pick.randrange(100)] = pick.choice(words)
        texts.append(" ".join(part))
    passage = " ".join(pick.choice(words) for _ in range(15))
    texts += [passage + " " + " ".join(pick.choice(words) for _ in range(pick.randrange(12))) for _ in range(60)]
    texts += [t.upper() for t in texts[:20]] + [t + " more" for t in texts[20:60]]
    pick.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, work, seed):
    rows = corpus(seed)
    found = {r.id: (r.n_shingles, r.component_id) for r in jaccard_groups(documents(*rows), work).collect()}
    assert found == brute(rows)


def test_the_last_step_alone_and_stars_first(documents, work, monkeypatch):
    rows = corpus(3, 60)
    wanted = brute(rows)
    for pairs, rounds in ((0, 2), (0, 1), (10**9, 6)):
        monkeypatch.setattr(join, "PAIRS_PER_POSTING", pairs)
        monkeypatch.setattr(join, "FEW_PER_POSTING", pairs)
        monkeypatch.setattr(join, "STAR_ROUNDS", rounds)
        found = jaccard_groups(documents(*rows), type(work)(work.spark)).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_crowded_counters_cost_time_only(documents, work, monkeypatch):
    monkeypatch.setattr(join, "COUNTERS", 1024)
    monkeypatch.setattr(join, "BLOCK", 256)
    rows = corpus(4, 60)
    found = {r.id: (r.n_shingles, r.component_id) for r in jaccard_groups(documents(*rows), work).collect()}
    assert found == brute(rows)


def test_null_blank_repeated_rows_and_null_ids(documents, work):
    long = " ".join(f"x{i}" for i in range(30_000))
    docs = documents((1, None), (2, " \n"), (3, "a b"), (4, "A  B"), (4, "A  B"), (None, "a\tb"), (6, "a c"), (7, long), (8, long + " y"))
    found = sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_groups(docs, work).collect()), key=str)
    wanted = [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (4, 1, 3), (None, 1, 3), (6, 1, 6), (7, 29_996, 7), (8, 29_997, 7)]
    assert found == sorted(wanted, key=str)
    assert jaccard_groups(documents().limit(0), type(work)(work.spark)).count() == 0
    kept = drop_near_copies(docs, type(work)(work.spark))
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6, 7]


def test_rows_that_share_an_id_are_told_apart(documents, work):
    first, second = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [
        (1, first), (None, first + " z"),  # one group with a null id
        (None, "clean one of its own"), (None, "another clean text here"), (None, None), (None, None),
        (5, "clean text of five"), (5, first + " y"),  # a clean text and a copy with one id
        (None, second), (None, second + " z"), (None, second + " y"),  # no id at all
        (7, "c d e f g h"), (7, "c d  e f g h"),  # copies with one id
    ]
    kept = [(r.doc_id, r.text) for r in drop_near_copies(documents(*rows), work).collect()]
    assert (1, first) in kept and len(kept) == 8
    assert sorted(t or "" for i, t in kept if i is None and not (t or "").startswith("b0")) == ["", "", "another clean text here", "clean one of its own"]
    assert sum((t or "").startswith("b0") for _, t in kept) == 1
    assert [t for i, t in kept if i == 5] == ["clean text of five"]
    assert len([t for i, t in kept if i == 7]) == 1


def test_words_do_not_depend_on_pieces(monkeypatch):
    data = b"  some words\tof a text " * 40
    begins, hashes = hashed_words(data)
    monkeypatch.setattr(join, "CUT_BYTES", 9)
    again = hashed_words(data)
    assert (begins == again[0]).all() and (hashes == again[1]).all()
    assert [data[b:].split()[0] for b in begins] == data.split()


def test_sets_by_text():
    texts = ["a b c d e f", "A b\nC d e  f", None, "", "a b", "a b c d e a b c d e"]
    sets = list(shingle_sets(texts))
    assert [len(s) for s in sets] == [2, 2, 0, 0, 1, 5]
    assert (sets[0] == sets[1]).all()


def test_postings_that_may_meet():
    draw = np.random.default_rng(0)
    rows = sorted((int(draw.integers(40)), int(draw.integers(5, 60)), int(draw.integers(4))) for _ in range(120))
    token, n, pos = (np.array(c) for c in zip(*rows, strict=True))
    keep = may_meet(token, n, pos, 80)
    for i, a in enumerate(rows):
        links = [b for j, b in enumerate(rows) if j != i and b[0] == a[0] and 100 * min(a[1], b[1]) >= 80 * max(a[1], b[1])
                 and 180 * min(a[1] - a[2], b[1] - b[2]) >= 80 * (a[1] + b[1])]
        if links:
            assert keep[i]
