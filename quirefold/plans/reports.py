"""Reports over the two tables: stats, list, show, search, delete previews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold import schemas
from quirefold.functions.text import is_truncated, preview, short_title
from quirefold.operators.embedding import embed_query
from quirefold.operators.select import by_id, of_types
from quirefold.operators.topk import batch_top_k, by_similarity, rank, ranked_top_k, score
from quirefold.plans.vector_index import VectorIndex
from quirefold.sources.store import DocumentStore


def totals(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    counted = documents.agg(F.count("*").alias("n")).select(F.lit("documents").alias("metric"), "n")
    return counted.unionByName(chunks.agg(F.count("*").alias("n")).select(F.lit("chunks").alias("metric"), "n"))


def per_type(documents: DataFrame) -> DataFrame:
    return documents.groupBy("doc_type").agg(F.count("*").alias("n")).orderBy("doc_type")


def date_span(documents: DataFrame) -> DataFrame:
    return documents.agg(F.min("meeting_date").alias("first_date"), F.max("meeting_date").alias("last_date"))


def stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """(metric, key, value): totals, documents per kind, first and last date.

    One pass over documents: totals are sums over the per-kind rows, which are as few as the kinds.
    """
    kinds = documents.groupBy("doc_type").agg(
        F.count("*").alias("n"), F.min("meeting_date").alias("lo"), F.max("meeting_date").alias("hi"))
    return _spread(kinds, chunks.agg(F.count("*").cast("string").alias("value")))


def stats_of(store: DocumentStore) -> DataFrame:
    """``stats`` of a store from its commits, without reading its tables."""
    kinds = store.totals().select("doc_type", F.col("documents").alias("n"), F.col("first_date").alias("lo"),
                                  F.col("last_date").alias("hi"), "chunks")
    return _spread(kinds.where("n > 0"), kinds.agg(F.coalesce(F.sum("chunks"), F.lit(0)).cast("string").alias("value")))


def _spread(kinds: DataFrame, n_chunks: DataFrame) -> DataFrame:
    overall = kinds.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("string").alias("documents"),
        F.min("lo").cast("string").alias("first_date"), F.max("hi").cast("string").alias("last_date"))
    spread = overall.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(m).alias("value"))
        for m in ("documents", "first_date", "last_date")])).alias("r")).select("r.*")
    by_kind = kinds.select(F.lit("documents_of_type").alias("metric"), F.col("doc_type").alias("key"),
                           F.col("n").cast("string").alias("value"))
    total = n_chunks.select(F.lit("chunks").alias("metric"), F.lit("").alias("key"), "value")
    return spread.unionByName(by_kind).unionByName(total)


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("document_id").agg(F.count("*").alias("chunks"))


def with_chunk_counts(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks are counted per document before the join, so the join moves one row per document."""
    return (documents.join(chunk_counts(chunks), "document_id", "left")
            .withColumn("chunks", F.coalesce("chunks", F.lit(0).cast("bigint"))))


def list_documents(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every document with its number of chunks, newest first, unknown dates last."""
    return (with_chunk_counts(documents.select("document_id", "doc_type", "meeting_date", "title"), chunks)
            .select("document_id", "doc_type", "meeting_date", "chunks", short_title(F.col("title")).alias("title"))
            .orderBy(F.desc_nulls_last("meeting_date"), "document_id"))


def show_document(documents: DataFrame, chunks: DataFrame, document_id: int) -> DataFrame:
    """One document with its chunks in order as previews; a document without chunks is one row."""
    parts = by_id(chunks, document_id).select(
        "document_id", "chunk_index", "chunk_size", "chunk_strategy",
        preview(F.col("chunk_text")).alias("preview"),
        is_truncated(F.col("chunk_text"), at_limit=True).alias("truncated"))
    return (by_id(documents, document_id)
            .select("document_id", "doc_type", "meeting_date", "title", "url", "page_count", "ingested_at")
            .join(parts, "document_id", "left").orderBy("chunk_index"))


def delete_preview(documents: DataFrame, chunks: DataFrame, document_id: int) -> DataFrame:
    """What a delete would remove: the document and its number of chunks; empty if not found."""
    counted = by_id(chunks, document_id).groupBy("document_id").agg(F.count("*").alias("chunks"))
    return (by_id(documents, document_id).select("document_id", "title", "doc_type", "meeting_date")
            .join(counted, "document_id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0).cast("bigint"))))


#: Largest k whose winners pass through the driver and are numbered in one task.
SMALL_K = 1_000
_RESULT = ("document_id", "title", "doc_type", "meeting_date", "url", "chunk_index", "chunk_text", "similarity")


def search(documents: DataFrame, chunks: DataFrame, query, k: int = fv.TOP_K, doc_type: str | None = None,
           complete: bool = False, candidates: DataFrame | None = None) -> DataFrame:
    """The k chunks nearest to a query vector with their documents; exact, facet before the limit.

    Scoring reads keys and vectors only. ``complete`` says that every chunk has its document and
    carries its kind, as the visible rows of a store do: then the facet prunes partitions, and the
    texts of the k winners are read by their ids, which files are sorted by. Otherwise chunks meet
    their documents first, as keys and scores, and orphans drop out before the limit. Beyond ``SMALL_K``
    winners stay a table that is joined by key. ``candidates`` (keys, embedding) are scored in place of all chunks.
    """
    keys = [c for c in schemas.CHUNK_KEY if c in chunks.columns]
    meta = documents.select("document_id", "title", "doc_type", "meeting_date", "url")
    owners = meta if doc_type is None else of_types(meta, [doc_type])
    wanted = of_types(chunks, [doc_type]) if complete and doc_type is not None else chunks
    scored = score((wanted if candidates is None else candidates).select(*keys, "embedding"), query)
    if not complete:
        scored = scored.join(owners.select("document_id"), "document_id", "left_semi")
    if k > SMALL_K:
        winners = ranked_top_k(scored, k, keys).select(*keys, "similarity", "rank")
        ranked = wanted.select(*keys, "chunk_text").join(winners, keys).join(meta, "document_id")
    elif complete:
        winners = scored.orderBy(*by_similarity(keys)).limit(k).select(*keys, "similarity")
        found = winners.collect()  # k rows
        ids = sorted({r["document_id"] for r in found})
        texts = wanted.where(F.col("document_id").isin(ids)).select(*keys, "chunk_text")
        best = (texts.join(F.broadcast(chunks.sparkSession.createDataFrame(found, winners.schema)), keys)
                .join(meta.where(F.col("document_id").isin(ids)), "document_id"))
        ranked = rank(best, keys)
    else:
        winners = scored.orderBy(*by_similarity(keys)).limit(k)
        best = chunks.select(*keys, "chunk_text").join(winners, keys).join(owners, "document_id")
        ranked = rank(best, keys)
    return ranked.select("rank", F.col("document_id").alias("doc_id"), *_RESULT[1:],
                         preview(F.col("chunk_text"), fv.SEARCH_PREVIEW_CHARS).alias("preview"))


def search_text(store: DocumentStore, text: str, k: int = fv.TOP_K, doc_type: str | None = None,
                provider: str = "hashing", nprobe: int | None = None, share: float | None = None, **options) -> DataFrame:
    """Search the store by a text, embedded by the provider of its chunks; with ``nprobe`` in so many cells of its index,
    with ``share`` in the nearest cells that hold that part of its rows."""
    query = embed_query(store.spark, text, provider, **options)
    exact = nprobe is None and share is None
    candidates = None if exact else VectorIndex(store).candidates(query, nprobe, doc_type, share)
    return search(store.documents(), store.chunks(), query, k, doc_type, complete=True, candidates=candidates)


def search_many(documents: DataFrame, chunks: DataFrame, queries: DataFrame, k: int = fv.TOP_K,
                doc_type: str | None = None, complete: bool = False) -> DataFrame:
    """The k nearest chunks of every (query_id, embedding), with their document's metadata.

    The facet applies before the limit. Chunks without a document drop out before it too, unless ``complete`` says
    that there are none.
    """
    if doc_type is not None and complete:
        chunks = of_types(chunks, [doc_type])
    if not complete:
        owners = documents if doc_type is None else of_types(documents, [doc_type])
        chunks = chunks.join(owners.select("document_id"), "document_id", "left_semi")
    found = batch_top_k(chunks, queries, k)
    return found.join(documents.select("document_id", "title", "doc_type", "meeting_date", "url"), "document_id")
