"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import Workspace
from .bpe import encoding_digests
from .chat_format import FOOTER, LOSS_ROLE, format_conversations, read_back
from .common import table
from .conversation_repair import damaged, repair_digests
from .exact_dedup import exact_copies, normalised
from .html_extract import extract, fit_extractor
from .jaccard_join import jaccard_groups
from .language_id import fit_languages, held_out, identify
from .mixing import mix
from .near_vectors import near_vectors
from .piece_encode import piece_digests
from .sharding import shard_by_bytes
from .suffix_dedup import remove_repeats
from .token_alignment import align_tokens

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
COSINE = 0.98
VOCABULARY = vocabulary_path("byte_bpe_50k.json")
PIECES = vocabulary_path("piece_bpe_32k.model")


def op1_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with its main text."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    model = fit_extractor(pages)
    return extract(pages, model, ["page_id", "url"]).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its shard and its place in it."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    placed = shard_by_bytes(docs, Workspace(spark), SHARDS)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the bytes removed from it, and the hash of what is left."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = remove_repeats(docs, Workspace(spark), digest=True)
    spans = F.arrays_zip("begins", "ends")
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["ends"] - s["begins"])
    return left.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.lower(F.hex("kept")).alias("kept_sha256"),
    )


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    docs = table(spark, folder, "documents")
    return encoding_digests(docs, VOCABULARY).withColumnRenamed("id", "doc_id")


def op5_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding with its links and the component they form."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    return near_vectors(vectors, Workspace(spark), COSINE).withColumnRenamed("id", "vec_id")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    taken = F.col("copies") * F.col("size")
    return mix(docs, Workspace(spark)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), "copies", "source"
    )


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one whose texts are marks of the template, read back from its format."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = FOOTER.strip() + "<|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, LOSS_ROLE, marks)], turns.schema)
    parts = format_conversations(turns.unionByName(extra), Workspace(spark))
    return read_back(parts).withColumnRenamed("conv", "conv_id")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's predicted language, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.filter(~held_out("doc_id")))
    return identify(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score"
    )


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the group of near copies it belongs to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard_groups(docs, Workspace(spark)).withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the document that stays for it."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    carry = {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(normalised("text"), 256)}
    found = exact_copies(docs, Workspace(spark), carry)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged by the checksums of its rows, with its faults and its cheapest repair."""
    turns = table(spark, folder, "conversations").select(F.col("conv_id").alias("conv"), "turn", "role", "text")
    return repair_digests(damaged(turns), Workspace(spark)).withColumnRenamed("conv", "conv_id")


def op12_piece_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's pieces, of the text decoded from them and of their source spans."""
    docs = table(spark, folder, "documents")
    return piece_digests(docs, PIECES).withColumnRenamed("id", "doc_id")


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the groups and links of its tokens in two vocabularies."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return align_tokens(docs, Workspace(spark), VOCABULARY, PIECES).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_html_extract": op1_html_extract,
    "op2_sharding": op2_sharding,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_bpe": op4_bpe,
    "op5_near_vectors": op5_near_vectors,
    "op6_mixing": op6_mixing,
    "op7_chat_format": op7_chat_format,
    "op8_language_id": op8_language_id,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_piece_encode": op12_piece_encode,
    "op13_token_alignment": op13_token_alignment,
}
