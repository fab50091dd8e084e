"""Corpus preparation in five stages, each of which works on what the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return rows of docs
with the columns of documents; the last returns how the mix takes each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import decontaminate, exact_dedup, language_id, mixing, ngram_jaccard
from docloom.llm.shared import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the model recognises, go."""
    return language_id.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id stays."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar 5-word shingle sets the one with the smallest doc_id stays."""
    return ngram_jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share windows of benchmark items go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and where it first appears in the schedule."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

#: SQL can't express the language model; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs, f"stage-{n}")
    return docs
