"""Targets by brute force; copies near the targets, whatever the shape of the sources."""

from collections import defaultdict

import pytest

import gainledger.llm.mixing as mixing
from gainledger.llm.mixing import mix, source_targets, take_copies


def brute_targets(sizes):
    """Fills sources up one after the other, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(names)}
    rest, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = 2 * sizes[s]
            rest -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, None: 500},
        {"a": 7},
        {"é": 50, "z": 50, "Z": 3, "": 9, None: 0},
        {"a": 0, "b": 0},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    wanted = brute_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(abs(found[s] - wanted[s]) < 1e-6 for s in found)


def mixed(docs, work):
    rows = mix(docs, work).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r.copies in (0, 1, 2)
        taken[r.source] += r.copies * r["size"]
        target[r.source] = r.target
    return rows, taken, target


def test_taken_words_come_near_the_targets(documents, work):
    rows = [(i, "w " * (1 + (i * 37) % 90), None, ["a", "b", "c", "d", None][i % 5]) for i in range(600)]
    found, taken, target = mixed(documents(*rows), work)
    assert len(found) == 600
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)
    again = {(r.id, r.copies) for r in mix(documents(*rows[::-1]), type(work)(work.spark)).collect()}
    assert again == {(r.id, r.copies) for r in found}


def test_one_size_for_most_rows_is_ranked_in_cells(documents, work, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", 50)
    rows = [(i, "same text here", None, "b") for i in range(800)] + [(1000 + i, "w " * i, None, "a") for i in range(1, 40)]
    found, taken, target = mixed(documents(*rows), work)
    assert len(found) == 839
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)


def test_null_blank_and_repeated_rows(documents, work):
    docs = documents((1, None, None, "a"), (2, " \n", None, None), (3, "x y", None, "a"), (3, "x y", None, "a"), (None, "z", None, "b"))
    found, _, _ = mixed(docs, work)
    assert sorted(r["size"] for r in found) == [0, 0, 1, 2, 2]
    assert all(r.copies == 1 for r in found if not r["size"])
    assert mix(documents().limit(0), work).count() == 0


def test_rows_come_out_as_often_as_they_are_taken(documents, work):
    docs = documents(*[(i, "w " * (1 + i % 9), None, "ab"[i % 2]) for i in range(60)])
    taken = take_copies(docs, work)
    assert taken.schema == docs.schema
    counts = defaultdict(int)
    for r in taken.collect():
        counts[r.doc_id] += 1
    assert max(counts.values()) <= 2
    assert sum(counts.values()) > 60


def test_what_is_taken_depends_on_the_rows_only(documents, work):
    rows = [(i, "w " * (1 + i % 3), None, "ab"[i % 2]) for i in range(120)]
    wanted = {r.id: r.copies for r in mix(documents(*rows), type(work)(work.spark)).collect() if r.copies}
    for order, parts in ((rows, 1), (rows[::-1], 7)):
        counts = defaultdict(int)
        for r in take_copies(documents(*order).repartition(parts), type(work)(work.spark)).collect():
            counts[r.doc_id] += 1
        assert counts == wanted
