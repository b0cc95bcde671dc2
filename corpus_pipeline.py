"""From raw documents to token digests: identified, deduplicated, mixed, encoded.

Every stage takes all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gainledger.llm.bpe import encoding_digests
from gainledger.llm.exact_dedup import drop_exact_copies
from gainledger.llm.jaccard_join import drop_near_copies
from gainledger.llm.language_id import drop_unidentified, fit_languages, held_out
from gainledger.llm.mixing import take_copies
from gainledger.llm.queries import VOCABULARY
from gainledger.operators.store import Workspace


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any text in a language go."""
    return drop_unidentified(docs, fit_languages(docs.filter(~held_out("doc_id"))))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return drop_exact_copies(docs, Workspace(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return drop_near_copies(docs, Workspace(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes out as often as the mix takes it."""
    return take_copies(docs, Workspace(spark))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of the text decoded from them."""
    return encoding_digests(docs, VOCABULARY).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixture),
    ("encoding", encoding),
]

# The mix and the groups of near copies are beyond SQL; the tests run the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage keeps is stored for the next."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = work.store(stage(spark, docs, sf_dir), f"stage_{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
