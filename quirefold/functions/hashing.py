"""Digests used as natural keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_hash(raw_bytes: Column | None, raw_text: Column | None) -> Column:
    """SHA-256 of the body: its bytes if there are any, else the UTF-8 of its text, else ''."""
    choice = F.when(F.lit(False), F.lit(""))
    if raw_bytes is not None:
        choice = choice.when(F.octet_length(raw_bytes) > 0, F.sha2(raw_bytes, 256))
    if raw_text is not None:
        choice = choice.when(F.length(raw_text) > 0, F.sha2(raw_text, 256))
    return choice.otherwise(F.lit(""))


def content_hash(text: Column, strategy: Column, size: Column, overlap: Column) -> Column:
    """SHA-256 of a chunk with the parameters that cut it, joined by NUL."""
    return F.sha2(F.concat_ws("\x00", text, strategy, size.cast("string"), overlap.cast("string")), 256)


def document_id(hash_col: Column) -> Column:
    """60-bit id taken from the source hash: stable over replays, needs no sequence."""
    return F.conv(F.substring(hash_col, 1, 15), 16, 10).cast("bigint")
