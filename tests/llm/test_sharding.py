"""Shards: near equal bytes, gapless slots, nothing lost."""

import zlib
from collections import defaultdict

import pytest

import gainledger.llm.sharding as sharding
from gainledger.llm.sharding import shard_by_bytes, with_range


def placed(docs, work, shards):
    rows = shard_by_bytes(docs, work, shards).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.shard].append(r)
    assert set(groups) <= set(range(shards))
    for group in groups.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    return rows, [sum(r["size"] for r in groups[s]) for s in range(shards)]


def test_sizes_are_near_equal_and_texts_stay_together(documents, work):
    rows = [(i, f"text {i} " * (1 + i % 7)) for i in range(2000)] + [(5000 + i, "copy " * 3) for i in range(30)]
    found, sizes = placed(documents(*rows), work, 40)
    assert len(found) == len(rows)
    assert max(sizes) - min(sizes) < 2 * max(r["size"] for r in found)
    texts = dict(rows)
    for r in found:
        assert r["size"] == len(texts[r.id].encode()) + 16
        assert r.crc == zlib.crc32(texts[r.id].encode())
    assert len({r.shard for r in found if r.id >= 5000}) <= 2


def test_one_text_with_most_rows_is_split(documents, work):
    rows = [(i, "the same text") for i in range(900)] + [(i, f"other {i}") for i in range(900, 1000)]
    found, sizes = placed(documents(*rows), work, 10)
    assert len(found) == 1000
    assert max(sizes) - min(sizes) < 100


def test_null_empty_repeated_and_few_rows(documents, work):
    found, _ = placed(documents((1, None), (2, ""), (2, ""), (None, "é" * 10)), work, 40)
    assert sorted((r["size"], r.crc) for r in found) == [(16, 0), (16, 0), (16, 0), (36, zlib.crc32(("é" * 10).encode()))]
    assert placed(documents().limit(0), work, 40)[0] == []


def test_overfull_ranges_are_split_again(documents, work, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
    monkeypatch.setattr(sharding, "OVERFULL", 1.2)
    rows = [(i, "x" * (i % 50)) for i in range(3000)]
    found, sizes = placed(documents(*rows), work, 8)
    assert len(found) == 3000
    assert max(sizes) - min(sizes) < 2 * 66


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 20])
def test_ranges_by_binary_search(spark, n):
    cuts = [f"{i:04x}" for i in range(10, 10 + 5 * n, 5)]
    keys = [f"{i:04x}" for i in range(0, 140, 3)]
    rows = with_range(spark.createDataFrame([(k,) for k in keys], "key string"), cuts).collect()
    assert {r.key: r.range for r in rows} == {k: sum(c <= k for c in cuts) for k in keys}
