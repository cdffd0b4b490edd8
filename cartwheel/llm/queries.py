"""The registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import (
    byte_bpe,
    decontamination,
    fingerprints,
    jaccard_join,
    mixing,
    ngram_lm,
    nra_search,
    packing,
    periodic_runs,
    sharding,
    toxicity,
    url_filters,
    warc,
)
from cartwheel.llm.common import read

TOKENIZER = "byte_bpe_50k.tiktoken"
# ids of the tokenizer, the free one after them pads
VOCABULARY, PAD = 50_256, 50_256


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.verdicts(read(spark, sf_dir, "pages"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return byte_bpe.digests(documents, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.written(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, PAD, VOCABULARY + 1)
    return packing.summary(rows)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read(spark, sf_dir, "documents"), leaves=sharding.SHARDS)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(read(spark, sf_dir, "documents")).taken()


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(read(spark, sf_dir, "documents"))


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_search.top_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_fingerprints": op5_fingerprints,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_mixing": op11_mixing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_nra_search": op13_nra_search,
}
