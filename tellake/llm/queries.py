"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import oracles
from .byte_bpe import round_trip
from .decontaminate import contamination_digest
from .jaccard_join import jaccard_components
from .language_id import language_of
from .language_model import language_model_scores
from .license_scan import scan_licenses
from .line_dedup import fuzzy_line_dedup
from .mixing import mix_plan
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .quality import quality_verdicts
from .substring_dedup import substring_digest
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"), "doc_id", "text", "source", weights=(1.0, 2.0, 3.0))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), corpus_pipeline.VOCABULARY, "doc_id", "text", capacity=2048, end_id=50256)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), "doc_id", "text", n=4, num=85, den=100)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"), "doc_id", "text")


def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_line_dedup(table(spark, sf_dir, "documents"), "doc_id", "text", similarity=0.8, min_words=8)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text", containment=0.8)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(table(spark, sf_dir, "documents"), "doc_id", "text", length=20, start=10)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", most=32)


def mixing_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1 that SQL can express; the target in whole words."""
    return op1_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target").cast("long").alias("target"))


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op2."""
    return op2_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def language_model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7 that SQL can express, the base score to four decimals."""
    return language_model_scores(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def queries() -> dict:
    named = {f.__name__: f for f in (op1_mixing, op2_quality_rules, op3_token_packing, op4_language_id, op5_ngram_jaccard_join, op6_decontamination, op7_language_model, op8_fuzzy_line_dedup, op9_license_scan, op10_substring_dedup, op11_prefix_trie, op12_byte_bpe, op13_whitening, mixing_base, quality_rules_base, language_model_base)}
    return {"pipeline": corpus_pipeline.run, **named}


def oracle_sql() -> dict[str, str]:
    return {
        "mixing_base": oracles.MIXING_BASE,
        "quality_rules_base": oracles.QUALITY_BASE,
        "op5_ngram_jaccard_join": oracles.JACCARD,
        "op6_decontamination": oracles.CONTAMINATION,
        "language_model_base": oracles.LANGUAGE_MODEL_BASE,
        "op10_substring_dedup": oracles.SUBSTRINGS,
        "op11_prefix_trie": oracles.PREFIX_TRIE,
    }
