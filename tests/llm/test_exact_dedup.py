"""Exact copies against SQL and by hand."""

from pyspark.sql import functions as F

from gainledger.llm.exact_dedup import drop_exact_copies, exact_copies


def found(docs, work):
    rows = exact_copies(docs, work, {"doc_id": F.col("doc_id")}).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows), key=str)


def test_longest_original_then_smallest_id_stays(documents, work):
    docs = documents((1, "a b"), (2, "ab"), (3, "a \t b"), (4, "a \n b"), (5, "abc"), (6, "a b"))
    assert found(docs, work) == [
        (1, 3, 4, False), (2, 3, 4, False), (3, 3, 4, True), (4, 3, 4, False), (5, 5, 1, True), (6, 6, 1, True),
    ]


def test_same_length_and_prefix_but_other_text(documents, work):
    docs = documents((1, "x" * 100 + "a"), (2, "x" * 100 + "b"), (3, "x" * 100 + "a"))
    assert found(docs, work) == [(1, 1, 2, True), (2, 2, 1, True), (3, 1, 2, False)]


def test_null_blank_repeated_rows_and_null_ids(documents, work):
    docs = documents((4, None), (2, ""), (3, " \n"), (7, "same"), (7, "same"), (None, "z"), (9, "z"))
    rows = found(docs, work)
    assert [r for r in rows if r[0] in (2, 3, 4)] == [(2, 3, 3, False), (3, 3, 3, True), (4, 3, 3, False)]
    assert sorted(r[3] for r in rows if r[0] == 7) == [False, True]
    assert (None, 9, 2, False) in rows


def test_empty_table_and_long_text(documents, work):
    assert found(documents().limit(0), work) == []
    long = "word " * 200_000
    assert found(documents((1, long), (2, long.replace(" ", ""))), work) == [(1, 1, 2, True), (2, 1, 2, False)]


def test_beyond_the_broadcast_bound_the_result_is_the_same(documents, work, monkeypatch):
    docs = documents(*[(i, f"text {i // 3}") for i in range(60)])
    whole = found(docs, work)
    monkeypatch.setattr("gainledger.llm.exact_dedup.LOOKUP_ROWS", 0)
    monkeypatch.setattr("gainledger.llm.common.LOOKUP_ROWS", 0)
    assert found(docs, type(work)(docs.sparkSession)) == whole


def test_dropping_keeps_the_columns(documents, work):
    docs = documents((1, "a"), (2, "a"), (3, "b"))
    left = drop_exact_copies(docs, work)
    assert left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]
