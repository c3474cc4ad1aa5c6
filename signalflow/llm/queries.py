"""Registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from signalflow.llm import alignment, bpe, exact_dedup, factorization, html_extract, line_join, mixing, order_minhash, prefix_trie, quality, secrets, separator_scan, sharding
from signalflow.llm.common import documents

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; a NULL or empty page has an empty one."""
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every whole text, by three patterns and by tests of randomness."""
    return secrets.secret_spans(documents(spark, sf_dir))


# free id of the vocabulary that ends a document
END_OF_DOCUMENT = 50256


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files without an index."""
    return separator_scan.token_counts(documents(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN, END_OF_DOCUMENT)


def op4_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines with words, those that an earlier line matches, and links between lines."""
    return line_join.line_verdicts(documents(spark, sf_dir))


# of the registered mixture: tokens to deliver as a share of all, and the most passes over a leaf
MIX_SHARE, MIX_EPOCHS = 1.0, 2


def op5_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is delivered under the budgets of domain, language and source."""
    return mixing.mixed_documents(documents(spark, sf_dir), MIX_SHARE, MIX_EPOCHS)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return quality.quality_rules(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and which one of it stays."""
    return exact_dedup.exact_classes(documents(spark, sf_dir))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return order_minhash.near_classes(documents(spark, sf_dir))


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in a reproducible shuffle."""
    return sharding.shard_documents(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every text and of what they decode to."""
    return bpe.token_digests(documents(spark, sf_dir), VOCABULARY, public_tokenizers.PATTERN)


def op11_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the labels of a quarter of the ids are never learnt from."""
    return factorization.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


# the two tokenizers that are aligned
ALIGN_A, ALIGN_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of two tokenizers over every whole text, and how common the links are."""
    return alignment.align(documents(spark, sf_dir), ALIGN_A, ALIGN_B)


def op13_double_array_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_suffix_array, op2_secret_scan, op3_separator_scan, op4_line_join, op5_mix_to_weights, op6_quality_rules, op7_exact_dedup, op8_order_minhash, op9_feistel_shards, op10_byte_bpe, op11_factorization_machine, op12_fragment_alignment, op13_double_array_trie)
}
ORACLES: dict[str, str] = {
    "op5_mix_to_weights": mixing.oracle(MIX_SHARE, MIX_EPOCHS),
    "op7_exact_dedup": exact_dedup.SQL,
    "op13_double_array_trie": prefix_trie.SQL,
}
