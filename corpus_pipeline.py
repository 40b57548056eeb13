"""From raw documents to packed training sequences, one stage after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larderlens.llm import exact_dedup, language_id, minhash_dedup, packing, substring_dedup
from larderlens.llm.common import settle
from larderlens.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text stays when its language is more likely right than not.
LEAST_SCORE = 0.5


def accept_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those whose language is told with a score below LEAST_SCORE."""
    return language_id.keep_accepted(docs, language_id.train(docs), LEAST_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near documents one stays."""
    return minhash_dedup.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are taken out of the texts."""
    return substring_dedup.shorten(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its place in a sequence."""
    return packing.pack_documents(docs, vocabulary_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", accept_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Language models, signatures and tokenizers are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
