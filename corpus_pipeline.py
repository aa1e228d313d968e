"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a table that is written as Parquet and read again as the next one's docs. All but
the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pactmill import session
from pactmill.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup, queries


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Documents without a letter and those the network is unsure of go."""
    queries.prepare(spark)
    net = language_id.fit(docs.where(language_id.remainder("doc_id", 4) != 2))
    return language_id.recognised(docs, net)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    queries.prepare(spark)
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    queries.prepare(spark)
    return near_dedup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    queries.prepare(spark)
    return mixing.mixture(docs, seed=queries.SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to."""
    queries.prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.coded(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("bpe", encode)]

# a trained network decides in the first stage, so there is no SQL for the result; tests compare it with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = session.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
