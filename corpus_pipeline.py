"""Cleaning pipeline: toxic texts go, one document of each group of near copies stays, contaminated
documents go, what is left is encoded.

Each stage takes all that its predecessor kept, as a written table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import byte_bpe, decontamination, jaccard_join, toxicity
from cartwheel.llm.common import materialise, read
from cartwheel.llm.queries import TOKENIZER


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.acceptable(docs, read(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("jaccard_join", without_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", encoded),
]

# the first and the last stage have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
