"""Document text from page rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.functions.text import has_text, strip_ws

# A text is one value in one row, and Spark holds at most 2 GiB in a value.
MAX_VALUE_BYTES = 1 << 30
TOO_LARGE = "document text too large for one value"


def page_stats(pages: DataFrame, key: str = "doc_key") -> DataFrame:
    """Per document: page_count (empty pages too), text bytes and whether any page has text.

    Plain partial aggregates, so a document's pages shrink to one row per map task.
    """
    return pages.groupBy(key).agg(
        F.count("*").cast("int").alias("page_count"),
        F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0)).alias("text_bytes"),
        F.max(has_text(F.col("text"))).alias("has_text"),
    )


def page_texts(pages: DataFrame, wanted: DataFrame, key: str = "doc_key") -> DataFrame:
    """(key, text) of the wanted documents: non-empty pages in page order, joined by one line feed, stripped.

    A text is one value, so its pages end up in one row; ``wanted`` must leave out documents over
    ``MAX_VALUE_BYTES``. Pages of other documents are dropped before anything is gathered.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return (pages.where("text <> ''").join(wanted.select(key), key, "left_semi")
            .groupBy(key).agg(ordered.alias("_pages"))
            .select(key, strip_ws(F.array_join(F.transform("_pages", lambda p: p["text"]), "\n")).alias("text")))


def assemble_pages(pages: DataFrame, key: str = "doc_key", max_bytes: int = MAX_VALUE_BYTES) -> DataFrame:
    """(key, text, page_count, error) of every document that has text.

    A document too large for one value comes back without its text and with an error.
    """
    stats = page_stats(pages, key).where("has_text")
    fits = stats.where(F.col("text_bytes") <= max_bytes)
    error = F.when(F.col("text_bytes") > max_bytes, F.lit(TOO_LARGE))
    return (stats.join(page_texts(pages, fits, key), key, "left")
            .select(key, "text", "page_count", error.alias("error")))
