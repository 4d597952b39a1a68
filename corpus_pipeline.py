"""Documents to training sequences: quality, language, near duplicates, private data, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import language, ordinal, packing, pii, simhash
from isobar.session import scratch_path

# A document stays if P(quality >= 1) is at least this.
LEAST_QUALITY = 0.5
# Documents of the learned languages score 0.46 and more, other prose of these languages 0.37 and more, other
# languages in Latin letters 0.23 at most and random letters 0.17 (measured at sf 0.01; README).
LEAST_LANGUAGE = 0.3
TOKENIZER = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rating is likely 1 or more; learned from ``labels``."""
    model = ordinal.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.accept(docs, model, LEAST_QUALITY)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in one of the languages that ``lang`` names."""
    return language.accept(docs, language.learn(docs), LEAST_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of SimHash links: 4-word shingles, 4 bits."""
    return simhash.one_of_each(docs, shingle=4, radius=4)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs, pii.learn(docs))
    if "n_chars" not in clean.columns:
        return clean
    kind = dict(docs.dtypes)["n_chars"]
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most 2048 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("language_id", languages),
    ("simhash_near_dedup", near_duplicates),
    ("pii", private_data),
    ("best_fit_packing", sequences),
]

# Fitted models, hash fingerprints and tokenizers are beyond SQL; tests hold the stages against
# plain restatements.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
