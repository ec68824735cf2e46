"""The training-data pipeline: from documents to the token ids of a mixed corpus.

Each stage takes all rows that the one before it returned and returns the rows
it keeps, with the columns of documents; the last one returns token ids. Ids,
texts and sources may be null, ids and whole rows may repeat, texts may be empty
or very long, extra columns may have any names and are kept up to the last
stage; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weekfold.llm import bpe, exact_dedup, minhash, mixing, quality
from weekfold.session import settle, ship_package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer accepts; null and empty texts go, whatever their id."""
    return quality.good_rows(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; null counts as empty, and a null id is the smallest."""
    return exact_dedup.without_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest id.

    Texts without words and rows without an id are linked with nothing and stay.
    """
    return minhash.without_near_duplicates(docs, words=5)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; null sources form one source, without an id the text decides."""
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row, with digests of the ids and of the text they decode to; null texts have none."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES = [
    ("quality", _shipped(good_documents)),
    ("exact dedup", _shipped(distinct_documents)),
    ("near dedup", _shipped(dissimilar_documents)),
    ("mixing", _shipped(mixed_documents)),
    ("tokens", _shipped(token_ids)),
]

#: SQL cannot express the learned scorer or the vocabulary's merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
