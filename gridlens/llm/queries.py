"""One registered query per operator: whole tables, production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridlens.llm import ann, chat, decontam, langid, minhash, packing, quality, repair, seekable, sharding, simplex, suffix, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_langid(spark, sf_dir):
    return langid.predictions(_table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return sharding.shard_documents(spark, _table(spark, sf_dir, "documents"), shards=24)


def op3_chat(spark, sf_dir):
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op4_tokens(spark, sf_dir):
    return seekable.token_digest(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_suffix(spark, sf_dir):
    return suffix.repeats(spark, _table(spark, sf_dir, "documents"))


def op6_minhash(spark, sf_dir):
    return minhash.duplicates(spark, _table(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_quality(spark, sf_dir):
    return quality.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_neighbours(spark, sf_dir):
    return ann.neighbours(spark, _table(spark, sf_dir, "embeddings"))


def op10_packing(spark, sf_dir):
    return packing.pack_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_toxicity(spark, sf_dir):
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_repair(spark, sf_dir):
    return repair.repair_digest(spark, _table(spark, sf_dir, "conversations"))


def op13_clusters(spark, sf_dir):
    return simplex.cluster_digest(spark, _table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_langid, op2_sharding, op3_chat, op4_tokens, op5_suffix, op6_minhash, op7_decontamination, op8_quality, op9_neighbours, op10_packing,
                                      op11_toxicity, op12_repair, op13_clusters, pipeline)}
ORACLE = {"op3_chat": chat.ROTATE_SQL, "op7_decontamination": decontam.CONTAMINATION_SQL, "op13_clusters": simplex.CLUSTER_SQL}
