"""Runs over a landing folder: everything a run is given, in one call."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from quirefold.operators.select import dated_within, expand_doc_types
from quirefold.plans.ingest import IngestOptions, ingest_batch
from quirefold.plans.resolve import Incoming, beside, plan_ingest, resolve
from quirefold.sources.landing import BodyIndex, read_detail, read_listing, read_pages
from quirefold.sources.store import COUNTS, DocumentStore, RunManifest
from quirefold.streaming.incremental import ingest_stream


def landed_listing(spark: SparkSession, landing: str, doc_type: str = "all", date_from: date | None = None,
                   date_to: date | None = None, streaming: bool = False) -> DataFrame:
    """Listed documents of the wanted kinds and dates, the kinds in their order."""
    frames = [read_listing(spark, f"{landing}/listing", t, streaming) for t in expand_doc_types(doc_type)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return dated_within(out, date_from, date_to)


def landed_documents(store: DocumentStore, landing: str, listing: DataFrame, doc_type: str = "all") -> Incoming:
    """Listed documents with whatever bodies have landed by now; bodies are digested once, when a run first meets them."""
    spark = store.spark
    details = [read_detail(spark, f"{landing}/detail", t) for t in expand_doc_types(doc_type)]
    detail = details[0]
    for frame in details[1:]:
        detail = detail.unionByName(frame)
    bodies = BodyIndex(spark, store.root, f"{landing}/bodies").refresh()
    return resolve(listing, detail, bodies, read_pages(spark, f"{landing}/pages"))


def dry_run(spark: SparkSession, landing: str, doc_type: str = "all", date_from: date | None = None,
            date_to: date | None = None) -> DataFrame:
    """What a run would ingest, from listings alone; writes nothing."""
    return plan_ingest(landed_listing(spark, landing, doc_type, date_from, date_to), expand_doc_types(doc_type))


def run_batch(spark: SparkSession, landing: str, root: str, run_name: str, doc_type: str = "all",
              date_from: date | None = None, date_to: date | None = None, options: IngestOptions | None = None) -> dict:
    """Ingest a landing folder at once and return the summary. The run's parameters are kept and checked."""
    options = options or IngestOptions()
    manifest = RunManifest(spark, root)
    manifest.check(run_name, **options.provider_parameters())
    store = DocumentStore(spark, root).create()
    listing, settles = landed_listing(spark, landing, doc_type, date_from, date_to), store.quarantined_batches(run_name)
    if settles:  # an earlier run may have had other kinds or dates
        listing = beside(listing, store.waiting(run_name))
    done = ingest_batch(store, landed_documents(store, landing, listing, doc_type), options, run_name, settles=settles)
    manifest.save(run_name=run_name, processed_count=done["documents_processed"], last_processed_url=store.last_url(done["ingest_batch"]),
                  doc_type=",".join(expand_doc_types(doc_type)), date_from=date_from, date_to=date_to,
                  chunk_strategy=options.strategy, **options.provider_parameters())
    return {k: done[k] for k in COUNTS}


def run_incremental(spark: SparkSession, landing: str, root: str, run_name: str, doc_type: str = "all",
                    date_from: date | None = None, date_to: date | None = None, options: IngestOptions | None = None,
                    checkpoint: str | None = None):
    """Ingest what has arrived since this run name was last used: first documents of earlier listings that are still
    waiting for a body or a vector, then new listings; returns the running query."""
    store = DocumentStore(spark, root).create()
    listing = landed_listing(spark, landing, doc_type, date_from, date_to, streaming=True)
    return ingest_stream(store, listing, lambda batch: landed_documents(store, landing, batch, doc_type), run_name, options,
                         expand_doc_types(doc_type), date_from, date_to, checkpoint, retry=True)
