"""Corpus pipeline over ``documents``: reject toxic documents, keep one of each near-duplicate group, drop
documents with benchmark passages, mix the sources, and write token files.

Every stage takes what its predecessor kept, as Parquet; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obligato.llm import decontaminate, mixing, simhash, toxicity
from obligato.llm.common import table, written
from obligato.llm.queries import CATEGORIES, SLOPES, token_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on ``labels``, does not find toxic."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.clean_documents(docs, chain, "toxic")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash.keep_representatives(docs, shingle=4, max_distance=4, seed=42)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a ``benchmark`` item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a document taken several times is as many rows, one not taken is none."""
    return mixing.mixed_documents(docs, SLOPES, max_epochs=3)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, read back from the token files."""
    return token_table(docs)


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("decontamination", drop_contaminated),
          ("mixing", mix_sources), ("token_files", write_tokens)]
#: SQL cannot express the trained classifier; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
