"""Near-duplicate embeddings against brute force."""

import numpy as np
import pytest

import gainledger.llm.near_vectors as near
from gainledger.llm.components import connected
from gainledger.llm.near_vectors import near_vectors

VECTORS = "vec_id long, embedding array<float>, label int, row string, key string"


@pytest.fixture
def vectors(spark):
    return lambda *rows: spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)


def groups_of(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows, threshold=0.98):
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    close = (x @ x.T >= threshold) & (label[:, None] == label[None])
    np.fill_diagonal(close, False)
    group = groups_of(len(rows), np.argwhere(np.triu(close)).tolist())
    return {r[0]: (int(close[i].sum()), rows[group[i]][0]) for i, r in enumerate(rows)}


def cloud(seed=0, n=500, dim=16):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, dim))
    for i in range(0, n, 5):
        base[i + 1] = base[i] + draw.normal(size=dim) * 0.04
    base[100:160] = base[100] + draw.normal(size=(60, dim)) * 0.12  # a group with links and gaps
    return [(i, [float(v) for v in base[i]], int(i % 3 if i < 100 else 1)) for i in range(n)]


def test_against_brute_force(vectors, work):
    rows = cloud()
    found = {r.id: (r.n_links, r.component_id) for r in near_vectors(vectors(*rows), work, 0.98).collect()}
    assert found == brute(rows)


def test_blocks_count_every_link_once(vectors, work, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    rows = cloud(3)
    found = {r.id: (r.n_links, r.component_id) for r in near_vectors(vectors(*rows), work, 0.98).collect()}
    assert found == brute(rows)


def dense(n, pairs, dim=64, seed=5):
    """One label whose vectors are at cosine 0.9 of each other, with pairs planted at 0.985."""
    draw = np.random.default_rng(seed)
    x = np.sqrt(0.1) * draw.normal(size=(n, dim)) / np.sqrt(dim)
    x[:, 0] = np.sqrt(0.9)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 2 * pairs, 2):
        away = draw.normal(size=dim)
        away -= (away @ x[i]) * x[i]
        x[i + 1] = 0.985 * x[i] + np.sqrt(1 - 0.985**2) * away / np.linalg.norm(away)
    return [(i, v.tolist(), 1) for i, v in enumerate(x)]


def test_dense_label_larger_than_the_windows(vectors, work, monkeypatch):
    rows = dense(3000, 200)
    whole = near.window_links
    monkeypatch.setattr(near, "window_links", lambda c, t: whole(c, t, 2, 5))
    monkeypatch.setattr(near, "REST_BYTES", 500 * 8 * 64)
    found = {r.id: (r.n_links, r.component_id) for r in near_vectors(vectors(*rows), work, 0.98).collect()}
    assert found == brute(rows)


def test_neighbours_in_different_tasks_are_compared(spark, vectors, work, monkeypatch):
    rows = dense(400, 150)
    whole = near.window_links
    monkeypatch.setattr(near, "window_links", lambda c, t: whole(c, t, 1, 400))  # one pass, a window that holds all
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        result = {r.id: (r.n_links, r.component_id) for r in near_vectors(vectors(*rows), work, 0.98).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert result == brute(rows)


def test_joining_pairs_connect_what_links(monkeypatch):
    x = np.array([r[1] for r in cloud(7, 300)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    wanted = groups_of(300, np.argwhere(np.triu(x @ x.T >= 0.9, 1)).tolist())
    for numbers in (near.NUMBERS, 40):
        monkeypatch.setattr(near, "NUMBERS", numbers)
        found = near.joining_pairs(x, x, np.arange(300), np.arange(300), 0.9)
        assert groups_of(300, found) == wanted and len(found) == 300 - len(set(wanted))


def test_copies_of_one_vector_are_one_class(vectors, work):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(200)] + [(500, [1.0, 2.0, 3.01], 1), (501, [-1.0, 0.0, 0.0], 1)]
    found = {r.id: (r.n_links, r.component_id, r.kept) for r in near_vectors(vectors(*rows), work, 0.98).collect()}
    assert found[0] == (200, 0, True) and found[7] == (200, 0, False)
    assert found[500] == (200, 0, False) and found[501] == (0, 501, True)


def test_vectors_that_link_with_nothing(vectors, work):
    good = [1.0, 0.0]
    odd = [None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(i, v, 1) for i, v in enumerate(odd)] + [(10, good, None), (11, good, None), (12, good, 1), (13, good, 2), (14, [1.0], 1)]
    found = near_vectors(vectors(*rows), work, 0.98).collect()
    assert len(found) == len(rows)
    assert all((r.n_links, r.component_id, r.kept) == (0, r.id, True) for r in found)


def test_repeated_rows_null_ids_and_empty_table(vectors, work):
    rows = [(3, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (None, [2.0, 2.0], 1), (None, [5.0, -5.0], 1)]
    found = [(r.id, r.n_links, r.component_id) for r in near_vectors(vectors(*rows), work, 0.98).collect()]
    assert sorted(found, key=str) == sorted([(3, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None)], key=str)
    assert near_vectors(vectors(*rows).limit(0), work, 0.98).count() == 0


def test_components_of_paths_and_stars(spark, work):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (60, 59), (None, 3)]
    found = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long"), work).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 61)}
    assert connected(spark.createDataFrame([], "a long, b long"), work, "none").count() == 0
