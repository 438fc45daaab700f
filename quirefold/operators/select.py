"""Row selections over documents: kind, date range, id, blank and oversized texts."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold.functions.dates import in_date_range
from quirefold.functions.text import has_text


def expand_doc_types(doc_type: str | None) -> tuple[str, ...]:
    """'all' (or nothing) stands for every kind."""
    return fv.DOC_TYPES if doc_type in (None, "all") else (doc_type,)


def of_types(df: DataFrame, doc_types, col: str = "doc_type") -> DataFrame:
    """Rows of the given kinds; prunes partitions on a table laid out by kind."""
    return df.where(F.col(col).isin(*doc_types))


def dated_within(df: DataFrame, date_from: date | None, date_to: date | None, col: str = "meeting_date") -> DataFrame:
    return df.where(in_date_range(F.col(col), date_from, date_to))


def not_blank(df: DataFrame, col: str = "text") -> DataFrame:
    return df.where(has_text(F.col(col)))


def within_bytes(c: Column, max_bytes: int = fv.MAX_TEXT_BYTES) -> Column:
    """Size guard: counts UTF-8 bytes, not characters."""
    return F.octet_length(c) <= max_bytes


def by_id(df: DataFrame, document_id: int, col: str = "document_id") -> DataFrame:
    """Point lookup; an empty frame means not found."""
    return df.where(F.col(col) == document_id)
