"""From raw documents to token ids: the corpus operators as five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalflow.llm import bpe, exact_dedup, mixing, order_minhash, quality
from signalflow.llm.common import documents
from signalflow.session import written

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# Words to deliver as a share of all that the stages before have kept, and passes over a leaf: none is repeated.
MIX_SHARE, MIX_EPOCHS = 0.75, 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest id."""
    return order_minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budgets of domain, language and source take."""
    return mixing.deliver(docs, MIX_SHARE, MIX_EPOCHS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    made = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, round_trip=True)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return made.select(
        "doc_id", "lang", "source", "token_ids",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]

# The near duplicates of the third stage have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
