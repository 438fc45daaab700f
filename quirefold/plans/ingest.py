"""Ingestion of one batch of documents.

The order of work keeps heavy data still. A narrow pass (hash, key and metadata, no text) finds the
documents that are new, and is written down as the batch's pending list. Only then are texts read
again for those documents, cleaned, chunked and embedded. A re-run over known input stops after the
narrow pass.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold import schemas
from quirefold.functions.hashing import document_id
from quirefold.functions.text import clean_text
from quirefold.operators.chunking import check_strategy, chunk_documents, chunk_rows
from quirefold.operators.dedup import first_wins, skip_known
from quirefold.operators.embedding import embed, provider_factory
from quirefold.operators.quality import first_broken, row_rules
from quirefold.operators.select import within_bytes
from quirefold.plans.resolve import Incoming, as_listing
from quirefold.plans.vector_index import VectorIndex
from quirefold.sources.landing import UNREADABLE
from quirefold.sources.store import COUNTS, DocumentStore


@dataclass
class IngestOptions:
    strategy: str = fv.CHUNK_STRATEGY
    size: int = fv.CHUNK_SIZE
    overlap: int = fv.CHUNK_OVERLAP
    min_ratio: float = fv.MIN_RATIO
    max_chunks: int = fv.MAX_CHUNKS_PER_DOC
    max_bytes: int = fv.MAX_TEXT_BYTES
    patterns: tuple = fv.BOILERPLATE_PATTERNS
    provider: str = "hashing"
    provider_options: dict = field(default_factory=dict)
    batch_size: int = fv.EMBED_BATCH
    skip_errors: bool = True
    #: Kinds that documents may have; None allows any.
    doc_types: tuple | None = fv.DOC_TYPES

    def check(self) -> None:
        check_strategy(self.strategy, self.size, self.overlap)

    def rules(self) -> list:
        """What a document must keep by itself to be stored."""
        return row_rules(("url", "title", "doc_type", "source_hash"), {"doc_type": self.doc_types} if self.doc_types else None)

    def provider_parameters(self) -> dict:
        """What a run must keep to add to the same tables."""
        provider = provider_factory(self.provider, **self.provider_options)()
        return {"embedding_model": provider.model, "embedding_dimensions": provider.dimensions,
                "chunk_size": self.size, "chunk_overlap": self.overlap}


def new_documents(narrow: DataFrame, known: DataFrame) -> DataFrame:
    """Documents to process: first of each body, not stored yet, without error. No text is moved."""
    fresh = skip_known(first_wins(narrow.where("error is null"), schemas.ORDER_KEY), known)
    return fresh.withColumn("document_id", F.when(F.col("source_hash") != "", document_id(F.col("source_hash"))))


BROKEN_RULE = "violates "


def _one_id_each(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """New documents, with an error where another text has the same id already, in the store or earlier in the batch.

    Ids are 60 bits of the hash, so two texts may share one; their chunks must not be taken for one document's.
    """
    taken = fresh.select("document_id").join(stored, "document_id", "left_semi").distinct().withColumn("taken", F.lit(True))
    first = (fresh.where("has_text").groupBy("document_id").agg(F.min("source_hash").alias("first"), F.max("source_hash").alias("last"))
             .where("first <> last").select("document_id", "first"))
    marked = fresh.join(taken, "document_id", "left").join(first, "document_id", "left")
    clash = F.col("has_text") & (F.col("taken") | (F.col("source_hash") != F.col("first")))
    return marked.withColumn("error", F.when(clash, F.lit(BROKEN_RULE + "unique:document_id"))).select(*fresh.columns)


def build_chunks(documents: DataFrame, options: IngestOptions, oversize: Observation | None = None,
                 truncated: Observation | None = None) -> DataFrame:
    """Chunk rows with hashes of documents (document_id, ..., text); map-only.

    The observations count texts over the size limit, which get no chunks, and documents with more chunks than are kept.
    """
    cleaned = documents.withColumn("text", clean_text(F.col("text"), options.patterns))
    if oversize is not None:
        over = ~F.coalesce(within_bytes(F.col("text"), options.max_bytes), F.lit(True))
        cleaned = cleaned.observe(oversize, F.count_if(over).alias("n"))
    chunks = chunk_documents(cleaned, "text", options.strategy, options.size, options.overlap, options.min_ratio,
                             options.max_chunks, options.max_bytes, truncated=truncated)
    return chunk_rows(chunks, options.strategy, options.size, options.overlap)


@dataclass
class PreparedBatch:
    """A batch that has been written and waits for its commit."""

    store: DocumentStore
    name: str
    since: int
    values: dict

    def commit(self) -> dict:
        """Make it visible and return its counts (COUNTS) and ``ingest_batch``; see DocumentStore.commit.

        If the store has a vector index, the batch is added to it; should that break off, the next commit makes up for it.
        """
        done = self.store.commit(self.name, self.since, **self.values)
        VectorIndex(self.store).add()
        return done


def ingest_batch(store: DocumentStore, incoming: Incoming, options: IngestOptions, run_name: str,
                 source_batch: str | None = None, settles: list[str] | None = None) -> dict:
    """Process one batch and return its counts (COUNTS) and ``ingest_batch``, the name it is stored under.

    The attempt writes under a name of its own and becomes visible by its commit, so one that breaks off leaves nothing
    and may be repeated. A ``source_batch`` that the run has committed already is not taken again. ``settles`` names
    batches whose quarantined documents are among the incoming ones.
    """
    if source_batch is not None and (done := store.committed(run_name, source_batch)) is not None:
        return done
    return prepare_batch(store, incoming, options, run_name, source_batch, settles).commit()


def prepare_batch(store: DocumentStore, incoming: Incoming, options: IngestOptions, run_name: str,
                  source_batch: str | None = None, settles: list[str] | None = None) -> PreparedBatch:
    """Do all the work of a batch but its commit."""
    options.check()
    spark, batch, since = store.spark, uuid.uuid4().hex, store.version()
    tag = F.lit(batch).alias("ingest_batch")
    parameters = options.provider_parameters()
    store.check_dimensions(parameters["embedding_dimensions"])

    # One pass over what comes in, written down: keys, hashes, and the rule that a row breaks, if any.
    def written_down(rows: DataFrame, name: str) -> DataFrame:
        path = f"{store.path('pending')}/{batch}-{name}"
        rows.write.parquet(path)
        return spark.read.parquet(path)

    broken = F.concat(F.lit(BROKEN_RULE), first_broken(options.rules()))
    narrow = written_down(incoming.narrow.withColumn("error", F.coalesce("error", broken)), "narrow")
    fresh = written_down(new_documents(narrow, store.known_hashes()), "fresh")
    decided = written_down(_one_id_each(fresh, store.documents().select("document_id")), "decided")
    pending = decided.where("error is null")

    rejected = (*schemas.ORDER_KEY, "url", "title", "doc_type", "meeting_number", "meeting_date", "error",
                F.lit(run_name).alias("run_name"), tag)
    bad = narrow.where("error is not null").select(*rejected).unionByName(decided.where("error is not null").select(*rejected))
    if not options.skip_errors:
        first_bad = bad.first()
        if first_bad is not None:
            raise ValueError(f"cannot ingest {first_bad['title']!r}: {first_bad['error']}")
    with_text = pending.where("has_text")

    oversize, truncated, stored = Observation(), Observation(), Observation()
    texts = incoming.texts(with_text.where("not oversize")).select("document_id", "doc_type", "text")
    chunks = build_chunks(texts, options, oversize, truncated)
    embedded = embed(chunks, "cleaned_text", options.provider, options.batch_size,
                     not options.skip_errors, **options.provider_options)
    # Counted where they are written, by the tasks that write them.
    store.write_batch("chunks", embedded.withColumn("created_at", F.current_timestamp()).withColumn("ingest_batch", tag)
                      .observe(stored, F.count(F.lit(1)).alias("n"), F.count("embed_error").alias("failed")))

    chunks_inserted = stored.get.get("n", 0)
    if stored.get.get("failed", 0):
        failed_path = f"{store.path('failed')}/{batch}"
        store.embed_failures(batch).write.parquet(failed_path)
        failed = spark.read.parquet(failed_path)
        bad = bad.unionByName(with_text.drop("error").join(failed, "document_id").select(*rejected))
        store.mark_deleted(failed.select(
            "document_id", tag, F.lit(None).alias("doc_type"), F.lit(0).alias("documents"), "chunks"), batch)
        with_text = with_text.join(failed, "document_id", "left_anti")
        pending = pending.join(failed, "document_id", "left_anti")
        chunks_inserted -= failed.agg(F.sum("chunks")).first()[0]
    rejections, processed = Observation(), Observation()
    store.write_batch("quarantine", bad.observe(rejections, F.count(F.lit(1)).alias("n")))
    store.write_batch("documents", with_text.withColumn("ingested_at", F.current_timestamp()).withColumn("ingest_batch", tag)
                      .observe(processed, F.count_if("oversize").alias("oversize")))
    return PreparedBatch(store, batch, since, {
        "run_name": run_name, "source_batch": source_batch, "settles": settles,
        "embedding_dimensions": parameters["embedding_dimensions"],
        "documents_processed": pending.count(), "chunks_inserted": chunks_inserted,
        "quarantined": rejections.get.get("n", 0),
        "oversize": processed.get.get("oversize", 0) + oversize.get.get("n", 0), "truncated": truncated.get.get("n", 0)})


def retry_waiting(store: DocumentStore, prepare: Callable[[DataFrame], Incoming], options: IngestOptions,
                  run_name: str) -> dict | None:
    """Try the quarantined documents of a run once more; the counts of that batch, or None if nothing waits.

    ``prepare`` looks listed documents up among what has landed by now. Those that still fail are quarantined anew.
    """
    batches, waiting = store.quarantined_batches(run_name), store.waiting(run_name)
    if not batches or waiting.where(F.col("error") != UNREADABLE).first() is None:
        return None
    return ingest_batch(store, prepare(as_listing(waiting)), options, run_name, settles=batches)


def ingest(spark: SparkSession, root: str, incoming: Incoming, run_name: str,
           options: IngestOptions | None = None) -> dict:
    """Batch run over a whole input, in addition to what is stored; a repeated run inserts nothing."""
    done = ingest_batch(DocumentStore(spark, root).create(), incoming, options or IngestOptions(), run_name)
    return {k: done[k] for k in COUNTS}
