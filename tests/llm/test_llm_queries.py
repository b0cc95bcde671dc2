"""The registered queries: check SQL, contracts' columns, and the whole pipeline by brute force."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from gainledger.llm.language_id import fit_languages, held_out, identify  # noqa: E402
from gainledger.llm.mixing import mix  # noqa: E402
from gainledger.llm.oracle import ORACLE  # noqa: E402
from gainledger.llm.queries import QUERIES  # noqa: E402
from gainledger.operators.store import Workspace  # noqa: E402
from tests.llm.test_jaccard_join import brute  # noqa: E402

COLUMNS = {
    "op1_html_extract": ["page_id", "url", "text", "n_chars"],
    "op2_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_near_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op6_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op10_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op11_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_piece_encode": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op13_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


def test_every_query_has_a_contract():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_columns_and_rows(spark, folder, engine, name):
    result = QUERIES[name](spark, folder)
    assert result.columns[: len(COLUMNS[name])] == COLUMNS[name]
    result = result.toPandas()
    source = {"op1": "pages", "op5": "embeddings", "op7": None, "op11": None}.get(name.split("_")[0], "documents")
    if source:
        key = {"pages": "page_id", "embeddings": "vec_id"}.get(source, "doc_id")
        wanted = engine.execute(f"SELECT {key} FROM {source} ORDER BY 1").fetchdf()[key].tolist()
        assert sorted(result[key].tolist()) == wanted
    if name in ORACLE:
        expected = engine.execute(ORACLE[name]).fetchdf()
        columns = sorted(expected.columns)
        assert sorted(result.columns) == columns
        same = [f[columns].astype(str).sort_values(columns).reset_index(drop=True) for f in (expected, result)]
        assert same[0].equals(same[1])


def test_pipeline_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pred = {r.id: r.lang_pred for r in identify(docs, fit_languages(docs.filter(~held_out("doc_id")))).collect()}
    rows = [r for r in docs.collect() if pred[r.doc_id] != "und"]
    best = {}
    for r in rows:
        key = "".join(c for c in r.text if c not in " \t\n\x0b\x0c\r")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    rows = [r for r in rows if r.doc_id in {d for _, d in best.values()}]
    groups = brute([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if groups[r.doc_id][1] == r.doc_id]
    left = spark.createDataFrame(rows, docs.schema)
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))

    result = corpus_pipeline.run(spark, folder).collect()
    texts = {r.doc_id: r.text for r in rows}
    assert {r.doc_id for r in result} <= set(texts)
    for r in result[:50]:
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
    # What the mix takes from the rows left is decided by their sizes up to single documents.
    taken = sum(len(texts[r.doc_id].split()) for r in result)
    wanted = sum(r.copies * r["size"] for r in mix(left, Workspace(spark)).collect())
    assert abs(taken - wanted) < 0.02 * wanted


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes, name
    assert duckdb is not None and corpus_pipeline.ORACLE_SQL is None
