"""A corpus pipeline: language, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it again as the next
stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import decontam, langid, minhash, packing, suffix
from gridlens.llm.common import bounded_batches, stored, workspace


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: no letter, or no language that the network is sure of."""
    return langid.reject(docs)


#: Share of the union of 5-word shingles, in percent, from which on documents count as near-duplicates (op6 has 85).
NEAR_PERCENT = 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the smallest doc_id."""
    bounded_batches(spark)
    return minhash.deduplicate(spark, docs, NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings of 50 bytes or more that a smaller doc_id has; a document of which nothing is left goes."""
    bounded_batches(spark)
    left = suffix.remove_repeats(spark, docs.where("text <> ''"))
    return left.where("text <> ''").unionByName(docs.where("text IS NULL OR text = ''"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of benchmark items; a document that mostly consists of them goes."""
    bounded_batches(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens: the pieces of every document and where they stand."""
    return packing.pack_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("minhash_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", pack),
]

#: Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
