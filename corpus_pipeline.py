"""A training-text pipeline over documents: language, near copies, repeated passages, benchmark leaks, tokens.

Each stage's table is written as Parquet and read again as the next stage's docs, so a lost executor costs a stage at
most, and every stage judges all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import bpe, decontam, langid, neardup, substring
from framelake.llm.common import new_folder


def _by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a letter whose main language has at least half of the words; lang becomes the prediction. Models come from all labelled rows of docs."""
    model = langid.fit(docs.select("text", "lang"))
    out = langid.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    return out.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def _one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: that of least id, one without an id only where no other is. Texts without a word stay."""
    return neardup.one_of_each(docs)


def _without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 35 words or more that occur elsewhere; n_chars follows. Every document stays."""
    return substring.remove(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def _without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item occurs, with or without an id."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document that is left: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", _by_language),
    ("near_duplicates", _one_of_each_class),
    ("repeated_passages", _without_repeats),
    ("benchmark_leaks", _without_leaks),
    ("tokens", _tokens),
]

#: Mixture inference, sketches, automata and BPE can't be put into SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
