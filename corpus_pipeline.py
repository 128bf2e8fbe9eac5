"""From raw documents to token ids: filter by quality, drop exact and near copies, mix sources, encode and decode.

Each stage takes what the stage before wrote and returns a frame that is written in turn. All but
the last return the columns of ``documents``; the last returns the identifier, the source, the number of
tokens, the token ids and the digest of what they decode to of every copy the mix takes.

No ``ORACLE_SQL``: trees and lasso weights, the shingle hashes and the token ids cannot be said in
SQL, so tests hold the rows against a plain reading of each stage.

Defined cases are those of the operators; an empty table passes through all stages as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsewise.llm import bpe, exact_dedup, mixing, quality, similar
from lapsewise.sources.workspace import Scratch

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, learned from ``labels``, rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: candidates by SimHash and MinHash, 5-word shingles, similarity 0.8 or more."""
    return similar.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, token_ids`` of every row, and ``decoded_sha256`` of the text these decode to."""
    return bpe.encode(docs, ("doc_id", "source"), decoded=True)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("byte_level_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written as Parquet and read again by the next."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
