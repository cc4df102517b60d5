"""The queries of this subpackage: one for each operator and the pipeline of the repository's top folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bitsliced, byte_bpe, byte_cnn, hmm_lm, line_dedup, merkle, near_dup, packing, quality_rules, secrets, token_rollups, vector_dup, whitening
from .folds import in_fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents")).drop("found")


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), with_text=False)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(hmm_lm.learn(_table(spark, sf_dir, "documents")))


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = byte_cnn.train(docs, _table(spark, sf_dir, "labels"))
    scored = byte_cnn.score(docs, model)
    held_out = in_fold(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollups.maintained_totals(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_vector_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_decode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_lowered(_table(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_secrets": op2_secrets,
    "op3_near_dup": op3_near_dup,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_hmm": op6_hmm,
    "op7_quality_cnn": op7_quality_cnn,
    "op8_token_rollups": op8_token_rollups,
    "op9_vector_dup": op9_vector_dup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_top_k": op13_top_k,
}

ORACLE_SQL: dict[str, str] = {
    "op3_near_dup": near_dup.oracle_sql(),
    "op4_quality_rules": quality_rules.oracle_sql(),
    "op5_line_dedup": line_dedup.oracle_sql(),
    "op9_vector_dup": vector_dup.oracle_sql(),
    "op12_merkle": merkle.oracle_sql(),
    "op13_top_k": bitsliced.oracle_sql(),
}
