"""Corpus pipeline: documents to packed token rows, in five stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tellake.llm import decontaminate, jaccard_join, language_id, mixing, packing
from tellake.llm.store import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a language that the labelled rows teach; null texts and texts without letters go."""
    return language_id.in_known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row by id (null ids last) of each group of near copies: five-word shingles, Jaccard 0.8.  Rows without words are no copies and stay."""
    return jaccard_join.one_per_component(docs, n=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no ten-word passage of the benchmark; null texts hold none.  Rows are judged one by one, whatever their ids."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources to weights 1, 2, 3 takes them, none to three times; a null source is a source."""
    return mixing.mixed(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids of 2048; null texts give none, empty texts their end token."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]

#: clustering, hashing and encoding are not SQL; tests/llm compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each works on what the one before wrote."""

    def step(docs: DataFrame, stage: tuple) -> DataFrame:
        name, f = stage
        out = f(spark, docs, sf_dir)
        return out if name == STAGES[-1][0] else materialize(out, f"stage-{name}")

    return reduce(step, STAGES, spark.read.parquet(f"{sf_dir}/documents.parquet"))
