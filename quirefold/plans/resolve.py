"""From listings to documents with a body: selection, lookup of details, choice of the body."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold import schemas
from quirefold.functions.hashing import source_hash
from quirefold.functions.text import has_text, html_to_text
from quirefold.operators.pages import MAX_VALUE_BYTES, page_stats, page_texts
from quirefold.operators.select import dated_within, of_types
from quirefold.sources.landing import UNREADABLE, body_key

NO_BODY = "no body"


def plan_ingest(listing: DataFrame, doc_types=fv.DOC_TYPES, date_from: date | None = None,
                date_to: date | None = None) -> DataFrame:
    """Dry run: what would be ingested. Reads no detail and no body."""
    wanted = dated_within(of_types(_with_errors(listing).where("list_error is null"), doc_types), date_from, date_to)
    return wanted.select("doc_type", "meeting_number", "title", "meeting_date")


def detail_url():
    """Address of a document's detail, stored as url of documents without a PDF."""
    url = F.when(F.lit(False), F.lit(""))
    for doc_type, prefix in fv.DETAIL_URLS.items():
        url = url.when(F.col("doc_type") == doc_type, F.concat(F.lit(prefix), F.col("meeting_number").cast("string")))
    return url


def _with_errors(listing: DataFrame) -> DataFrame:
    """The listing with ``list_error``, null where it comes from no landed payload."""
    return listing if "list_error" in listing.columns else listing.withColumn("list_error", F.lit(None).cast("string"))


@dataclass
class Incoming:
    """Documents to ingest.

    ``narrow`` has one INCOMING row per document. ``texts`` takes some of its rows, all with a text,
    and returns them with the column ``text``. So a run decides what is new from keys and hashes and
    then reads the texts of new documents only; when those are few, the planner broadcasts them and
    texts are not shuffled at all.
    """

    narrow: DataFrame
    texts: Callable[[DataFrame], DataFrame]

    def with_texts(self) -> DataFrame:
        """All documents; those without text have null, or '' where a body was there."""
        found = self.texts(self.narrow.where("has_text and not oversize and error is null")).select(*schemas.ORDER_KEY, "text")
        blank = F.when(F.col("error").isNull() & ~F.col("from_pages"), F.lit(""))
        return (self.narrow.join(found, list(schemas.ORDER_KEY), "left")
                .withColumn("text", F.coalesce("text", blank)))


def _or_own_key(condition, key):
    """A join key where the condition holds, elsewhere one of the row's own that matches nothing.

    Rows without a key would otherwise all be null and meet in one task of an outer join.
    """
    own = F.concat_ws("/", F.lit("none"), *[F.col(c).cast("string") for c in schemas.ORDER_KEY])
    return F.when(condition, key).otherwise(own)


def as_listing(quarantined: DataFrame) -> DataFrame:
    """Quarantined documents as listed ones, to be looked up again; their payloads are not read."""
    return quarantined.select("source_ord", "list_file", "list_pos", "doc_type", "meeting_number", "title", "meeting_date",
                              F.when(F.col("error") == UNREADABLE, F.col("error")).alias("list_error"))


def beside(listing: DataFrame, quarantined: DataFrame) -> DataFrame:
    """A listing and the quarantined documents that it does not hold; of an unreadable payload, if it is still not listed."""
    broken = F.col("error") == UNREADABLE
    lost = quarantined.where(broken).join(listing.where("list_error is null").select("source_ord", "list_file").distinct(),
                                          ["source_ord", "list_file"], "left_anti")
    rest = as_listing(quarantined.where(~broken).unionByName(lost)).join(listing, list(schemas.ORDER_KEY), "left_anti")
    return listing.unionByName(rest)


def _detail_key():
    return F.concat_ws("/", "doc_type", F.col("meeting_number").cast("string"))


def resolve(listing: DataFrame, detail: DataFrame, bodies: DataFrame, pages: DataFrame,
            max_bytes: int = MAX_VALUE_BYTES) -> Incoming:
    """Find the body of every listed document.

    A PDF whose bytes are there decides, even without any text; else the HTML text; else the row
    carries an error. A text too large for one value is not gathered: its document is kept as ``oversize``, and gets no
    chunks. ``detail`` has one row per (doc_type, meeting_number) and ``bodies`` one per
    doc_key, as landed files do. Only digests and page counts are joined here.
    """
    html_text = F.when(F.col("html") != "", html_to_text(F.col("html")))
    details = (detail.withColumn("html_text", html_text).select(
        _detail_key().alias("detail_key"), "pdf_url", (F.col("html") != "").alias("has_html"),
        source_hash(None, F.col("html_text")).alias("html_hash"), has_text(F.col("html_text")).alias("html_has_text")))
    stats = page_stats(pages).withColumnRenamed("has_text", "pages_have_text")
    found = (_with_errors(listing).withColumn("detail_key", _or_own_key(F.col("list_error").isNull(), _detail_key()))
             .join(details, "detail_key", "left")
             .withColumn("doc_key", _or_own_key(F.col("pdf_url") != "", body_key(F.col("pdf_url"))))
             .join(bodies, "doc_key", "left").join(stats, "doc_key", "left"))
    is_pdf = F.col("body_hash").isNotNull()
    is_html = ~is_pdf & F.coalesce("has_html", F.lit(False))
    too_large = is_pdf & F.coalesce(F.col("text_bytes") > max_bytes, F.lit(False))
    narrow = found.select(
        *schemas.ORDER_KEY,
        F.when(is_pdf, F.col("pdf_url")).otherwise(detail_url()).alias("url"),
        "title", "doc_type", "meeting_date", "meeting_number",
        F.when(is_pdf, F.col("body_hash")).when(is_html, F.col("html_hash")).otherwise("").alias("source_hash"),
        is_pdf.alias("from_pages"),
        F.when(is_pdf, F.col("page_count")).alias("page_count"),
        F.when(is_pdf, F.coalesce("pages_have_text", F.lit(False)))
        .otherwise(is_html & F.col("html_has_text")).alias("has_text"),
        too_large.alias("oversize"),
        F.coalesce("list_error", F.when(~is_pdf & ~is_html, NO_BODY)).alias("error"),
    )

    def texts(documents: DataFrame) -> DataFrame:
        paged = documents.where("from_pages").withColumn("doc_key", body_key(F.col("url")))
        html = documents.where("not from_pages").join(detail.select("doc_type", "meeting_number", "html"),
                                                      ["doc_type", "meeting_number"])
        return (paged.join(page_texts(pages, paged), "doc_key").select(*documents.columns, "text")
                .unionByName(html.select(*documents.columns, html_to_text(F.col("html")).alias("text"))))

    return Incoming(narrow, texts)


def from_texts(df: DataFrame, source_ord: int = 0) -> Incoming:
    """Documents whose text is at hand (list_pos, url, title, doc_type, meeting_date, text)."""
    keyed = df.select(F.lit(source_ord).alias("source_ord"), F.lit("").alias("list_file"),
                      F.col("list_pos").cast("bigint").alias("list_pos"),
                      "url", "title", "doc_type", "meeting_date", "text")
    text = F.col("text")
    narrow = keyed.select(
        *schemas.ORDER_KEY, "url", "title", "doc_type", "meeting_date", F.lit(None).cast("int").alias("meeting_number"),
        source_hash(None, text).alias("source_hash"), F.lit(False).alias("from_pages"),
        F.lit(None).cast("int").alias("page_count"), has_text(text).alias("has_text"),
        F.lit(False).alias("oversize"), F.lit(None).cast("string").alias("error"))

    def texts(documents: DataFrame) -> DataFrame:
        return documents.join(keyed.select(*schemas.ORDER_KEY, "text"), list(schemas.ORDER_KEY))

    return Incoming(narrow, texts)
