"""Explicit schemas of every table and payload; no reader infers."""

from pyspark.sql import types as T

LISTING = T.StructType([
    T.StructField("conteudo", T.ArrayType(T.StructType([
        T.StructField("dataReferencia", T.StringType()),
        T.StructField("nroReuniao", T.IntegerType()),
        T.StructField("nro_reuniao", T.IntegerType()),
        T.StructField("titulo", T.StringType()),
    ]))),
])

DETAIL = T.StructType([
    T.StructField("conteudo", T.ArrayType(T.StructType([
        T.StructField("urlPdfAta", T.StringType()),
        T.StructField("textoAta", T.StringType()),
        T.StructField("textoComunicado", T.StringType()),
    ]))),
])

PAGES = T.StructType([
    T.StructField("doc_key", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

# Unique key of an incoming document, and its first-wins order.
ORDER_KEY = ("source_ord", "list_file", "list_pos")

# What is known of an incoming document before its text is read.
INCOMING = T.StructType([
    T.StructField("source_ord", T.IntegerType()),
    T.StructField("list_file", T.StringType()),
    T.StructField("list_pos", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("meeting_date", T.DateType()),
    T.StructField("meeting_number", T.IntegerType()),
    T.StructField("source_hash", T.StringType()),
    T.StructField("from_pages", T.BooleanType()),
    T.StructField("page_count", T.IntegerType()),
    T.StructField("has_text", T.BooleanType()),
    T.StructField("oversize", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("meeting_date", T.DateType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_hash", T.StringType()),
    T.StructField("page_count", T.IntegerType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("ingest_batch", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("chunk_text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("chunk_strategy", T.StringType()),
    T.StructField("chunk_size", T.IntegerType()),
    T.StructField("chunk_overlap", T.IntegerType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("ingest_batch", T.StringType()),
])

QUARANTINE = T.StructType([
    T.StructField("source_ord", T.IntegerType()),
    T.StructField("list_file", T.StringType()),
    T.StructField("list_pos", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("meeting_number", T.IntegerType()),
    T.StructField("meeting_date", T.DateType()),
    T.StructField("error", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("ingest_batch", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("last_processed_url", T.StringType()),
    T.StructField("processed_count", T.LongType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("date_from", T.DateType()),
    T.StructField("date_to", T.DateType()),
    T.StructField("embedding_model", T.StringType()),
    T.StructField("embedding_dimensions", T.IntegerType()),
    T.StructField("chunk_size", T.IntegerType()),
    T.StructField("chunk_overlap", T.IntegerType()),
    T.StructField("chunk_strategy", T.StringType()),
    T.StructField("discarded", T.BooleanType()),
])

REQUIRED = {
    "documents": ("url", "title", "doc_type", "ingested_at", "source_hash"),
    "chunks": ("document_id", "chunk_index", "chunk_text", "cleaned_text", "chunk_strategy",
               "chunk_size", "chunk_overlap", "content_hash", "created_at"),
}
CHUNK_KEY = ("document_id", "chunk_index", "content_hash")
PARTITIONS = ("doc_type", "ingest_batch")

# One numbered row per commit. A batch is seen by readers once its row is there, and until another row replaces it.
COMMITS = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("ingest_batch", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("source_batch", T.StringType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
    # Batches whose quarantine has been tried again.
    T.StructField("settles", T.ArrayType(T.StringType())),
    T.StructField("embedding_dimensions", T.IntegerType()),
    T.StructField("documents_processed", T.LongType()),
    T.StructField("chunks_inserted", T.LongType()),
    T.StructField("quarantined", T.LongType()),
    T.StructField("oversize", T.LongType()),
    T.StructField("truncated", T.LongType()),
    # Rows written, and what the commit adds to (or takes from) the totals of each kind.
    T.StructField("rows", T.LongType()),
    T.StructField("kinds", T.ArrayType(T.StructType([
        T.StructField("doc_type", T.StringType()),
        T.StructField("documents", T.LongType()),
        T.StructField("chunks", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
    ]))),
    T.StructField("committed_at", T.TimestampType()),
])

# Documents taken out of a batch, together with their chunks, by the commit of that name; how many rows went.
DELETES = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("ingest_batch", T.StringType()),
    T.StructField("commit_name", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("documents", T.LongType()),
    T.StructField("chunks", T.LongType()),
])

# Digests of landed bodies, each file read once.
BODIES = T.StructType([
    T.StructField("doc_key", T.StringType()),
    T.StructField("body_hash", T.StringType()),
    T.StructField("modified", T.TimestampType()),
])

# One numbered row per change of a vector index; the last one names its centroids.
#: Files of batches that are laid out by id, with the ids they lie between.
FILES = T.StructType([
    T.StructField("tab", T.StringType()),
    T.StructField("ingest_batch", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("lo", T.LongType()),
    T.StructField("hi", T.LongType()),
])

INDEX = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("entry", T.StringType()),
    T.StructField("generation", T.StringType()),
    T.StructField("centroids", T.StringType()),
    T.StructField("batches", T.ArrayType(T.StringType())),
    T.StructField("next_cell", T.IntegerType()),
    T.StructField("sizes", T.ArrayType(T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType())]))),
])

CENTROIDS = T.StructType([
    T.StructField("cell", T.IntegerType()),
    T.StructField("centroid", T.ArrayType(T.DoubleType())),
])

INDEX_ROWS = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("doc_type", T.StringType()),
    T.StructField("ingest_batch", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("entry", T.StringType()),
    T.StructField("cell", T.IntegerType()),
])
