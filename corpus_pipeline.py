"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage works on all rows that the one before it kept. All but the last return the
columns of ``documents``; the last returns the stored place and checksum of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fringeframe.llm import decontaminate, jaccard, langid, mixing, token_store
from fringeframe.session import shared_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no language can be seen (null or without a letter) go."""
    return langid.keep_identified(docs)


def fold_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that the 5-word Jaccard join links at 0.8, the one with the least id stays."""
    return jaccard.keep_one(docs, percent=80, k=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark text go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3; a document appears once for each time it is taken."""
    return mixing.restate(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the mix, and where each row is in them."""
    return token_store.token_report(docs, public_tokenizers.path("byte_bpe_50k.json"), base=50_257)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", fold_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_store", store_tokens),
]

#: SQL can express neither the language profiles nor the tokenizer; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
