"""Document ingestion, chunking and vector search as Spark DataFrame operations."""

__version__ = "0.1.0"
