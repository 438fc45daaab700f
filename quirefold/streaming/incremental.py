"""Incremental, resumable runs: a file stream of listed documents into the store."""

import hashlib
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame

from quirefold import fixed_values as fv
from quirefold.plans.ingest import IngestOptions, ingest_batch, retry_waiting
from quirefold.plans.resolve import Incoming
from quirefold.sources.store import DocumentStore, RunManifest


def ingest_stream(store: DocumentStore, stream: DataFrame, prepare: Callable[[DataFrame], Incoming], run_name: str,
                  options: IngestOptions | None = None, doc_types=fv.DOC_TYPES, date_from: date | None = None, date_to: date | None = None,
                  checkpoint: str | None = None, retry: bool = False):
    """Start ingesting what has arrived and stop; returns the running query.

    ``stream`` is a streaming frame, for instance of listings, and ``prepare`` turns the rows of one
    micro-batch into documents, with whatever has landed by then. Selections go into either. Spark's checkpoint remembers which files a run has taken, so
    calling again under the same run name goes on where it stopped, and a batch that broke off is
    repeated. Its progress lies under the store's root. A new run name starts afresh. No state is kept besides the tables.

    With ``retry``, quarantined documents of this run go through ``prepare`` once more before the stream starts. So a
    document whose body lands after its listing is taken then, and no listing is read twice.
    """
    options = options or IngestOptions()
    options.check()
    store.create()
    manifest = RunManifest(store.spark, store.root)
    parameters = options.provider_parameters()
    manifest.check(run_name, **parameters)
    previous = manifest.latest(run_name)
    done = {"n": previous["processed_count"] if previous else 0}

    # Progress belongs to the store; a name may hold characters that a path may not.
    folder, generation = hashlib.sha256(run_name.encode()).hexdigest()[:32], manifest.generation(run_name)
    location = checkpoint or f"{store.root}/runs/{folder}" + (f"-{generation}" if generation else "")

    def record(summary: dict) -> None:
        done["n"] += summary["documents_processed"]
        manifest.save(run_name=run_name, last_processed_url=store.last_url(summary["ingest_batch"]),
                      processed_count=done["n"], doc_type=",".join(doc_types), date_from=date_from, date_to=date_to,
                      chunk_strategy=options.strategy, **parameters)

    def process(batch: DataFrame, batch_id: int) -> None:
        record(ingest_batch(store, prepare(batch), options, run_name, f"{location}#{batch_id}"))

    if retry and (again := retry_waiting(store, prepare, options, run_name)) is not None:
        record(again)
    return (stream.writeStream.foreachBatch(process).option("checkpointLocation", location)
            .trigger(availableNow=True).start())
