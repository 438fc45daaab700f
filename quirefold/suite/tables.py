"""Stand-in tables, as DataFrames and as SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions.hashing import content_hash
from quirefold.operators.chunking import window_chunks

# Window chunking used throughout the suite.
SIZE, OVERLAP = 100, 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return stand_in(table(spark, sf, "documents"))


def stand_in(d: DataFrame) -> DataFrame:
    """Rows of the given ``documents`` as documents of the engine."""
    date = F.when(F.col("doc_id") % 10 != 0,
                  F.date_add(F.lit("2000-01-01").cast("date"), (F.col("doc_id") % 5000).cast("int")))
    return d.select(F.col("doc_id").alias("document_id"), F.col("source").alias("url"),
                    F.substring_index("text", "\n", 1).alias("title"), F.col("lang").alias("doc_type"),
                    date.alias("meeting_date"), F.sha2("text", 256).alias("source_hash"), "text")


DOCS = r"""docs AS (
  SELECT doc_id AS document_id, source AS url, split_part(text, chr(10), 1) AS title, lang AS doc_type,
         CASE WHEN doc_id % 10 = 0 THEN NULL ELSE DATE '2000-01-01' + CAST(doc_id % 5000 AS INTEGER) END AS meeting_date,
         sha256(text) AS source_hash, text
  FROM documents)"""


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Window chunks of all documents, with their hashes."""
    d = table(spark, sf, "documents")
    pieces = window_chunks(F.col("text"), SIZE, OVERLAP)
    return (d.select(F.col("doc_id").alias("document_id"), F.posexplode(pieces).alias("chunk_index", "chunk_text"))
            .withColumn("chunk_strategy", F.lit("window"))
            .withColumn("chunk_size", F.lit(SIZE)).withColumn("chunk_overlap", F.lit(OVERLAP))
            .withColumn("content_hash", content_hash(F.col("chunk_text"), F.col("chunk_strategy"),
                                                     F.col("chunk_size"), F.col("chunk_overlap"))))


def window_sql(source: str, key: str, text: str = "text", name: str = "chunks") -> str:
    """CTEs that cut ``source.text`` into windows of words."""
    step = SIZE - OVERLAP
    return rf"""{name}_words AS (
  SELECT {key}, string_split_regex({text}, '\s+') AS w FROM {source}),
{name}_starts AS (
  SELECT {key}, w, unnest(range(1, greatest(1, len(w) - {OVERLAP}) + 1, {step})) AS start FROM {name}_words),
{name} AS (
  SELECT {key}, CAST((start - 1) // {step} AS INTEGER) AS chunk_index,
         array_to_string(w[start : start + {SIZE - 1}], ' ') AS chunk_text
  FROM {name}_starts)"""


CHUNKS = window_sql("docs", "document_id")
CONTENT_HASH = f"sha256(chunk_text || chr(0) || 'window' || chr(0) || '{SIZE}' || chr(0) || '{OVERLAP}')"
SPACES = "' ' || chr(9) || chr(10) || chr(13)"


def estimate_sql(text: str) -> str:
    return f"greatest(1, length({text}) // 4)"
