"""A corpus from raw documents to packed sequences, stage by stage."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm import decontaminate, packing, pii, quality, simhash
from quirefold.session import ship_package
from quirefold.sources.shared import shared_path

#: Key of the surrogates; a parameter of the operator, fixed here so that runs can be repeated.
PII_KEY = "corpus-pipeline"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality network, fitted on labelled rows, rejects."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose fingerprints are linked by three differing bits or fewer."""
    return simhash.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts surrogates in the place of personal data and counts the characters of changed texts anew."""
    out = pii.surrogated(docs, PII_KEY)
    n_chars = F.when(F.size("pii_kinds") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left into sequences."""
    # Rows carry their ids, and a worker keeps its words while other stages run; both take memory.
    return packing.pack(docs, TOKENIZER, characters=4 << 20, words=400_000)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("sequence_packing", sequence_packing),
]

#: SQL cannot express the quality network; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read by the next."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
