"""Language identification: held-out accuracy, what it may not look at, texts without letters."""

import zlib

import numpy as np
import pytest

from gainledger.llm.common import table
from gainledger.llm.language_id import Counter, drop_unidentified, fit_languages, fit_svm, held_out, identify


@pytest.fixture(scope="module")
def model(spark, folder):
    return fit_languages(table(spark, folder, "documents").filter(~held_out("doc_id")))


def test_held_out_accuracy(spark, folder, model):
    docs = table(spark, folder, "documents")
    pred = {r.id: r for r in identify(docs, model).collect()}
    rows = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert rows and len(pred) == docs.count()
    assert np.mean([pred[r.doc_id].lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in pred.values())


def test_prediction_depends_on_the_text_only(documents, model):
    text = "The and that of the thing in the end, with this for them and the other."
    docs = documents((1, text, "fr", "src1"), (2, text, None, None), (2, text, "de", "src0"))
    assert len({(r.lang_pred, r.score) for r in identify(docs, model).collect()}) == 1


def test_texts_without_letters(documents, model):
    docs = documents((1, None), (2, ""), (3, "12 34 -- !"), (4, "x" * 300_000), (None, "the and of"))
    found = {r.id: r for r in identify(docs, model).collect()}
    assert [(found[i].lang_pred, found[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert found[4].lang_pred != "und" and found[None].lang_pred != "und"
    kept = drop_unidentified(docs, model)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "None"]


def test_no_labelled_rows_and_one_language(documents):
    model = fit_languages(documents((1, "text", None)))
    assert [r.lang_pred for r in identify(documents((1, "text")), model).collect()] == ["und"]
    model = fit_languages(documents((1, "text here", "xx"), (2, "more text", "xx")))
    assert [r.lang_pred for r in identify(documents((1, "text")), model).collect()] == ["xx"]
    assert identify(documents().limit(0), model).count() == 0


def test_counts_do_not_depend_on_pieces(monkeypatch):
    count = Counter()
    text = "Some words, 12 of them. And Ünïcode too " * 30
    whole = count(text)
    monkeypatch.setattr("gainledger.llm.language_id.CHUNK_CHARS", 7)
    assert np.abs(count(text) - whole).max() < 0.02


def test_support_vectors_separate():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(80, 5)).astype(np.float32)
    y = np.where(x[:, 0] - x[:, 1] > 0, 1.0, -1.0)
    assert (np.sign(x @ fit_svm(x, y)) == y).mean() > 0.95


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(i,) for i in range(100)], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
