"""The operators applied to whole tables, as named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larderlens.llm import (
    conversation_trie,
    exact_dedup,
    html_extract,
    language_id,
    line_dedup,
    minhash_dedup,
    packing,
    phrases,
    quality_rules,
    sentencepiece_codec,
    slot_shards,
    substring_dedup,
    token_counts,
)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality_rules.rate(docs, quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dropped_lines(_documents(spark, sf_dir)).drop("text_key")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(_documents(spark, sf_dir), vocabulary_path("piece_bpe_32k.model"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(_documents(spark, sf_dir))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(_documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), vocabulary_path("piece_bpe_32k.model"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_shards.shard_documents(_documents(spark, sf_dir))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_documents(spark, sf_dir))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_line_dedup,
        op3_sentencepiece,
        op4_exact_dedup,
        op5_language_id,
        op6_minhash_dedup,
        op7_html_extraction,
        op8_substring_dedup,
        op9_best_fit_packing,
        op10_token_counts,
        op11_sharding,
        op12_phrase_mining,
        op13_conversation_trie,
    )
}
