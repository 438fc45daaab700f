"""The operators of this subpackage applied to the given tables, with DuckDB SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quirefold.llm import (alignment, block_dedup, decontaminate, exact_dedup, fingerprints, merkle, orc_tokens, packing, pii, quality, sharding,
                           simhash, suffix_dedup)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query
def op1_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_with_edits(_table(spark, sf, "documents"))


@_query
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


ORACLES["op2_decontamination"] = decontaminate.SQL


@_query
def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.report(_table(spark, sf, "documents"))


@_query
def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


@_query
def op5_block_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return block_dedup.report(_table(spark, sf, "documents"))


@_query
def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@_query
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_query
def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf, "documents"))


@_query
def op9_orc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return orc_tokens.round_trip(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.report(_table(spark, sf, "documents"), "documents")


@_query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.report(_table(spark, sf, "documents"))


ORACLES["op12_merkle_manifest"] = merkle.SQL


@_query
def op13_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.report(_table(spark, sf, "documents"))


ORACLES["op13_exact_dedup"] = exact_dedup.SQL


@_query
def op11_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.report(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
