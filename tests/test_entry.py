"""The entry file with and without the operators on training data."""

import importlib
import sys

import pytest

import __spark_entry__ as entry_file
from gainledger.queries import QUERIES


@pytest.fixture
def reloaded():
    def reload():
        return importlib.reload(entry_file)

    yield reload
    importlib.reload(entry_file)


@pytest.mark.parametrize("missing", ["public_tokenizers", "gainledger.llm", "gainledger.llm.queries", "corpus_pipeline"])
def test_profit_queries_need_no_operators(reloaded, monkeypatch, missing):
    for name in [n for n in sys.modules if n.startswith("gainledger.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # importing it fails
    found = reloaded()
    assert set(QUERIES) <= set(found.queries())
    assert "pipeline" not in found.queries()
    if missing != "corpus_pipeline":
        assert set(found.queries()) == set(QUERIES)
    assert set(found.oracle_sql()) <= set(found.queries())


def test_a_leftover_folder_is_no_subpackage(reloaded, monkeypatch, tmp_path):
    import gainledger

    for name in [n for n in sys.modules if n.startswith("gainledger.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    (tmp_path / "llm").mkdir()
    monkeypatch.setattr(gainledger, "__path__", [str(tmp_path)])
    assert set(reloaded().queries()) == set(QUERIES)
