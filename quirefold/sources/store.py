"""The stored tables: batches that become visible whole, by numbered commits.

Every attempt at a batch writes partitions of its own, and one commit makes it visible; readers see committed batches
only. So stored rows are never overwritten, a batch that broke off leaves nothing to be seen, and runs add up whatever
their names. Deletes are rows too, and take a document and its chunks out of a batch when their commit is there.
``compact`` writes what is visible anew, as one batch.

Writers don't wait for each other. Each remembers the version it has read and creates the next commit only if nobody
else has; otherwise it looks at what the later commits hold, gives way where they have the same documents, and tries again.
"""

import json
import uuid
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import schemas
from quirefold.sources.commit_log import CommitLog

_TABLES = {"documents": schemas.DOCUMENTS, "chunks": schemas.CHUNKS, "quarantine": schemas.QUARANTINE}
_ORDER = {"documents": ("meeting_date", "document_id"), "chunks": ("document_id", "chunk_index"),
          "quarantine": schemas.ORDER_KEY}
#: Columns that single documents are looked up by; files carry Bloom filters on them, so that most are not read for an id.
_LOOKED_UP = {"documents": ("document_id", "source_hash"), "chunks": ("document_id",), "quarantine": ()}
#: Rows of one file of a compacted batch, about.
FILE_ROWS = 1_000_000
# Kept in the chunk files of a batch for its own bookkeeping; not a column of the table.
EMBED_ERROR = T.StructField("embed_error", T.StringType())
COUNTS = ("documents_processed", "chunks_inserted", "quarantined", "oversize", "truncated")


class ConflictError(RuntimeError):
    """Another writer has changed what this one was about to replace."""


class DocumentStore:
    """Reads and writes of the tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.path("log"), schemas.COMMITS)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> "DocumentStore":
        """Create missing tables; safe to repeat."""
        for table, schema in _TABLES.items():
            (self.spark.createDataFrame([], schema).write.mode("ignore")
             .partitionBy(*schemas.PARTITIONS).parquet(self.path(table)))
        for table, schema in (("deletes", schemas.DELETES), ("files", schemas.FILES)):
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(table))
        self.log.bootstrap()
        return self

    def register(self, database: str = "default") -> None:
        """Make the tables known to the catalog, for SQL, as views of what is visible."""
        def columns(schema):
            return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        for table, schema in {**_TABLES, "deletes": schemas.DELETES}.items():
            parts = f"PARTITIONED BY ({', '.join(schemas.PARTITIONS)})" if table in _TABLES else ""
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.stored_{table} ({columns(schema)}) USING parquet "
                           f"{parts} LOCATION '{self.path(table)}'")
            if parts:
                self.spark.sql(f"MSCK REPAIR TABLE {database}.stored_{table}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.stored_commits ({columns(schemas.COMMITS)}) USING json LOCATION '{self.log.path}'")
        for table in (*_TABLES, "deletes", "commits"):
            self.spark.sql(f"REFRESH TABLE {database}.stored_{table}")
        commits = f"{database}.stored_commits"
        live = f"SELECT ingest_batch FROM {commits} WHERE ingest_batch NOT IN (SELECT explode(replaces) FROM {commits})"
        deletes = (f"SELECT document_id, ingest_batch FROM {database}.stored_deletes "
                   f"WHERE commit_name IN (SELECT ingest_batch FROM {commits})")
        for table in _TABLES:
            gone = (f" LEFT ANTI JOIN (SELECT explode(settles) AS ingest_batch FROM {commits}) x USING (ingest_batch)"
                    if table == "quarantine" else f" LEFT ANTI JOIN ({deletes}) x USING (document_id, ingest_batch)")
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT t.* FROM {database}.stored_{table} t "
                           f"LEFT SEMI JOIN ({live}) c USING (ingest_batch){gone}")

    # --- what is visible

    def version(self) -> int:
        return self.log.version()

    def rows(self, table: str) -> DataFrame:
        """All rows of a table's files, visible or not."""
        if table == "commits":
            return self.log.rows()
        schema = {**_TABLES, "deletes": schemas.DELETES, "files": schemas.FILES}[table]
        return self.spark.read.schema(schema).parquet(self.path(table))

    def commits(self) -> DataFrame:
        """Commits that no later one replaces."""
        every = self.rows("commits")
        return every.join(every.select(F.explode("replaces").alias("ingest_batch")), "ingest_batch", "left_anti")

    def deletes(self) -> DataFrame:
        """(document_id, ingest_batch) of committed deletes."""
        done = self.rows("commits").select(F.col("ingest_batch").alias("commit_name"))
        return self.rows("deletes").join(done, "commit_name", "left_semi").select("document_id", "ingest_batch")

    def read(self, table: str) -> DataFrame:
        """The visible rows of a table; of the quarantine those that have not been tried again."""
        return self._visible(table, self.rows(table))

    def _visible(self, table: str, rows: DataFrame) -> DataFrame:
        seen = rows.join(self.commits().select("ingest_batch"), "ingest_batch", "left_semi")
        if table == "quarantine":
            settled = self.rows("commits").select(F.explode("settles").alias("ingest_batch"))
            seen = seen.join(settled, "ingest_batch", "left_anti")
        else:
            seen = seen.join(self.deletes(), ["document_id", "ingest_batch"], "left_anti")
        return seen.select(*_TABLES[table].names)

    def documents(self) -> DataFrame:
        return self.read("documents")

    def chunks(self) -> DataFrame:
        return self.read("chunks")

    def lookup(self, table: str, document_id: int) -> DataFrame:
        """The visible rows of one document, as ``read`` gives them, from the files that can hold it.

        Compacted batches are laid out by id, and of these only files whose ids lie around it are opened; batches that
        are not compacted are read with their Bloom filters.
        """
        files = self.rows("files").where(F.col("tab") == table).join(self.commits().select("ingest_batch"), "ingest_batch", "left_semi")
        laid_out = [r[0] for r in files.select("ingest_batch").distinct().collect()]  # at most one row per batch
        paths = [r[0] for r in files.where(F.lit(document_id).between(F.col("lo"), F.col("hi"))).select("path").collect()]  # files that overlap there
        rows = self.rows(table).where(~F.col("ingest_batch").isin(laid_out)) if laid_out else self.rows(table)
        if paths:
            paths = [unquote(p) for p in paths]  # Spark names files as in addresses
            rows = rows.unionByName(self.spark.read.schema(_TABLES[table]).option("basePath", self.path(table)).parquet(*paths))
        return self._visible(table, rows.where(F.col("document_id") == document_id))

    def known_hashes(self) -> DataFrame:
        """Hashes of the stored documents."""
        return self.documents().select("source_hash")

    def waiting(self, run_name: str) -> DataFrame:
        """Quarantined documents of a run that have not been tried again."""
        return self.read("quarantine").where(F.col("run_name") == run_name)

    def quarantined_batches(self, run_name: str) -> list[str]:
        """Batches that hold quarantined rows of a run; a retry leaves one of them at most."""
        rows = self.read("quarantine").where(F.col("run_name") == run_name).select("ingest_batch").distinct()
        return [r[0] for r in rows.collect()]  # at most one per commit since the last retry

    def embed_failures(self, batch: str) -> DataFrame:
        """(document_id, error, chunks) of the batch's documents with a chunk that could not be embedded."""
        schema = T.StructType([*schemas.CHUNKS, EMBED_ERROR])
        return (self.spark.read.schema(schema).parquet(self.path("chunks")).where(F.col("ingest_batch") == batch)
                .groupBy("document_id").agg(F.min("embed_error").alias("error"), F.count("*").alias("chunks")).where("error is not null"))

    def last_url(self, batch: str) -> str | None:
        """Address of the batch's last document."""
        row = (self.documents().where(F.col("ingest_batch") == batch)
               .agg(F.max_by("url", F.struct("ingested_at", "document_id")).alias("url")).first())
        return row["url"]

    def committed(self, run_name: str, source_batch: str) -> dict | None:
        """Batch and counts of a run's batch that is stored already."""
        row = self.rows("commits").where((F.col("run_name") == run_name) & (F.col("source_batch") == source_batch)).first()
        return None if row is None else {k: row[k] for k in ("ingest_batch", *COUNTS)}

    def check_dimensions(self, dimensions: int) -> None:
        """Refuse vectors of another length than the stored ones."""
        other = self.commits().where(F.col("embedding_dimensions") != dimensions).first()
        if other is not None:
            raise ValueError(f"embedding_dimensions: stored {other['embedding_dimensions']}, current {dimensions}")

    # --- writes

    def write_batch(self, table: str, df: DataFrame) -> None:
        """Add the rows of an attempt, sorted so that row groups can be skipped; they are not visible yet."""
        fields = [*_TABLES[table], *([EMBED_ERROR] if EMBED_ERROR.name in df.columns else [])]
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in _LOOKED_UP[table]}
        (df.select(*[F.col(f.name).cast(f.dataType) for f in fields])
         .sortWithinPartitions(*schemas.PARTITIONS, *_ORDER[table])
         .write.mode("append").options(**filters).partitionBy(*schemas.PARTITIONS).parquet(self.path(table)))

    def mark_deleted(self, pairs: DataFrame, commit_name: str | Column) -> None:
        """Rows that take (document_id, ingest_batch, doc_type, documents, chunks) out once the commit is there."""
        (pairs.withColumn("commit_name", F.lit(commit_name) if isinstance(commit_name, str) else commit_name)
         .select(*[F.col(f.name).cast(f.dataType) for f in schemas.DELETES]).write.mode("append").parquet(self.path("deletes")))

    def create_commit(self, version: int, batch: str, **values) -> bool:
        row = {f.name: values.get(f.name) for f in schemas.COMMITS}
        row |= {"ingest_batch": batch, "replaces": row["replaces"] or [], "settles": row["settles"] or [],
                "committed_at": datetime.now(timezone.utc).isoformat()}
        return self.log.create(version, row)

    def commit(self, batch: str, since: int, **values) -> dict:
        """Make a batch visible and return its counts, as what was committed after version ``since`` allows.

        Documents that a later commit has brought in under the same hash are withdrawn with their chunks: one copy stays,
        that of the first to commit. A batch of a run that has been committed meanwhile is left unseen.
        """
        counts = {k: values.pop(k, None) or 0 for k in COUNTS}
        while True:
            version = self.version()
            if version > since:
                run_name, source_batch = values.get("run_name"), values.get("source_batch")
                if source_batch is not None and (done := self.committed(run_name, source_batch)) is not None:
                    return done
                lost = self._withdraw(batch, since)
                counts["documents_processed"] -= lost["documents"]
                counts["chunks_inserted"] -= lost["chunks"]
                since = version
            if self.create_commit(version + 1, batch, **values, **counts, **self._held(batch)):
                return {"ingest_batch": batch, **counts}

    def _held(self, batch: str) -> dict:
        """Rows of a batch that is not committed yet, and their totals by kind, without those it has withdrawn itself."""
        own = self.rows("deletes").where(F.col("commit_name") == batch).select("document_id", "ingest_batch")
        documents, chunks = (self.rows(t).where(F.col("ingest_batch") == batch).join(own, ["document_id", "ingest_batch"], "left_anti")
                             for t in ("documents", "chunks"))
        kinds = self._totals(documents.select("doc_type", "meeting_date", F.lit(1).alias("documents"), F.lit(0).alias("chunks")).unionByName(
            chunks.select("doc_type", F.lit(None).cast("date").alias("meeting_date"), F.lit(0).alias("documents"), F.lit(1).alias("chunks"))))
        return {"kinds": kinds, "rows": sum(k["documents"] + k["chunks"] for k in kinds)}

    @staticmethod
    def _totals(rows: DataFrame, sign: int = 1) -> list[dict]:
        """Sums of ``documents`` and ``chunks`` by kind, and the dates between which they lie; one row per kind."""
        found = rows.groupBy("doc_type").agg(
            (F.sum("documents") * sign).alias("documents"), (F.sum("chunks") * sign).alias("chunks"),
            F.min("meeting_date").cast("string").alias("first_date"), F.max("meeting_date").cast("string").alias("last_date"))
        return [r.asDict() for r in found.collect()]

    def _withdraw(self, batch: str, since: int) -> dict:
        """Mark the batch's documents that commits after ``since`` have brought in as well; how many rows that are."""
        later = self.commits().where(F.col("version") > since).select("ingest_batch")
        theirs = self.documents().join(later, "ingest_batch", "left_semi").select("source_hash")
        gone = (self.rows("documents").where(F.col("ingest_batch") == batch).select("document_id", "ingest_batch", "doc_type", "source_hash")
                .join(self.rows("deletes").where(F.col("commit_name") == batch), ["document_id", "ingest_batch"], "left_anti")
                .join(theirs, "source_hash", "left_semi").select("document_id", "ingest_batch", "doc_type", F.lit(1).alias("documents")))
        own = self.rows("chunks").where(F.col("ingest_batch") == batch).groupBy("document_id").agg(F.count("*").alias("chunks"))
        pairs = gone.join(own, "document_id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
        path = f"{self.path('pending')}/withdrawn-{uuid.uuid4().hex}"
        pairs.write.parquet(path)
        found = self.spark.read.parquet(path)
        lost = found.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks")).first()
        if lost["documents"]:
            self.mark_deleted(found, batch)
        return lost.asDict()

    def delete(self, keys: DataFrame) -> dict:
        """Delete documents and, in cascade, their chunks; returns the numbers of rows removed.

        Both go by one commit over (document, batch) pairs, so no reader sees one without the other. Chunks without a
        document are found as well, and a document that comes in again is in another batch. If another commit comes
        between, the pairs are looked up anew.
        """
        path = f"{self.path('pending')}/delete-{uuid.uuid4().hex}"
        keys.select("document_id").distinct().write.parquet(path)
        wanted = self.spark.read.parquet(path)
        while True:
            version, name = self.version(), uuid.uuid4().hex
            held = [self.read(t).select("document_id", "ingest_batch", "doc_type", F.lit(int(t == "documents")).alias("documents"),
                                        F.lit(int(t == "chunks")).alias("chunks")).join(wanted, "document_id", "left_semi")
                    for t in ("documents", "chunks")]
            pairs = held[0].unionByName(held[1]).groupBy("document_id", "ingest_batch", "doc_type").agg(
                F.sum("documents").alias("documents"), F.sum("chunks").alias("chunks"))
            self.mark_deleted(pairs, name)
            gone = self.rows("deletes").where(F.col("commit_name") == name).withColumn("meeting_date", F.lit(None).cast("date"))
            kinds = self._totals(gone, -1)
            if self.create_commit(version + 1, name, run_name="delete", kinds=kinds):
                return {c: -sum(k[c] for k in kinds) for c in ("documents", "chunks")}

    def delete_all(self) -> dict:
        """Empty the tables; returns how many documents and chunks went."""
        while True:
            version = self.version()
            counts = {t: self.read(t).count() for t in ("documents", "chunks")}
            if self.create_commit(version + 1, uuid.uuid4().hex, run_name="delete_all", replaces=self.live_batches()):
                return counts

    def _write_by_id(self, table: str, df: DataFrame, batch: str, file_rows: int) -> None:
        """Write a batch in ranges of ids, kind by kind, and note the ids that each file holds.

        Kinds are folders, so a range over all of them would become a file in each.
        """
        n = max(1, -(-df.count() // file_rows))
        self.write_batch(table, df.repartitionByRange(n, "doc_type", "document_id").withColumn("ingest_batch", F.lit(batch)))
        written = self.rows(table).where(F.col("ingest_batch") == batch)
        files = written.groupBy(F.input_file_name().alias("path")).agg(F.min("document_id").alias("lo"), F.max("document_id").alias("hi"))
        (files.select(F.lit(table).alias("tab"), F.lit(batch).alias("ingest_batch"), "path", "lo", "hi")
         .write.mode("append").parquet(self.path("files")))

    def compact(self, batches: list[str] | None = None, file_rows: int = FILE_ROWS) -> str:
        """Write the visible rows of all batches, or of some, anew as one, which takes their place; returns its name.

        Documents and chunks of a kind are laid out in ranges of ids, so that a document is looked up in few files.
        Deletes that are committed meanwhile are carried over. If another writer has replaced the same batches, this
        one gives up with ConflictError and leaves nothing to be seen.
        """
        since, batch = self.version(), uuid.uuid4().hex
        live = self.live_batches() if batches is None else batches
        dims = self.commits().where(F.col("ingest_batch").isin(live)).agg(F.max("embedding_dimensions")).first()[0]
        for table in _TABLES:
            kept = self.read(table).where(F.col("ingest_batch").isin(live))
            if table == "quarantine":
                self.write_batch(table, kept.withColumn("ingest_batch", F.lit(batch)))
            else:
                self._write_by_id(table, kept, batch, file_rows)
        held = self._held(batch)
        if batches is not None:
            # Deletes stay committed, but what they took from these batches is not there any more to be taken off.
            applied = self.rows("deletes").where(F.col("ingest_batch").isin(live) & (F.col("commit_name") != F.col("ingest_batch"))
                                                   & ~F.col("commit_name").isin(live))
            applied = applied.join(self.rows("commits").where(F.col("version") <= since).select(F.col("ingest_batch").alias("commit_name")),
                                   "commit_name", "left_semi")
            held["kinds"] += self._totals(applied.withColumn("meeting_date", F.lit(None).cast("date")))
        while True:
            version = self.version()
            if version > since:
                later = self.rows("commits").where(F.col("version") > since)
                replaced = later.select(F.explode("replaces").alias("name")).where(F.col("name").isin(live))
                if replaced.first() is not None:
                    raise ConflictError("batches to be compacted have been replaced by another writer")
                names = later.select(F.col("ingest_batch").alias("commit_name"))
                moved = self.rows("deletes").where(F.col("ingest_batch").isin(live)).join(names, "commit_name", "left_semi")
                self.mark_deleted(moved.withColumn("ingest_batch", F.lit(batch)), F.col("commit_name"))
                since = version
            if self.create_commit(version + 1, batch, run_name="compact", replaces=live, embedding_dimensions=dims, **held):
                return batch

    def compact_tiers(self, fan_in: int = 8) -> int:
        """Merge batches of like size until fewer than ``fan_in`` of any size are left; returns the rows written.

        A batch is of the tier of the power of ``fan_in`` that its rows reach, and only batches of one tier are merged, so
        a row is written again about once for each tier and not once for each compaction.
        """
        written = 0
        while True:
            tiers: dict[int, list[str]] = {}
            for r in self.commits().where("rows > 0").select("ingest_batch", "rows").collect():  # one row per batch
                tiers.setdefault(max(k for k in range(64) if fan_in ** k <= r["rows"]), []).append(r["ingest_batch"])
            full = [names for _, names in sorted(tiers.items()) if len(names) >= fan_in]
            if not full:
                return written
            batch = self.compact(full[0])
            written += self.rows("commits").where(F.col("ingest_batch") == batch).first()["rows"]

    def totals(self) -> DataFrame:
        """(doc_type, documents, chunks, first_date, last_date) of what is visible, from the commits.

        Dates of kinds that deletes have touched are looked up in the documents of those kinds, all else is in the commits.
        """
        entries = self.commits().select(F.explode("kinds").alias("k")).select("k.*")
        summed = entries.groupBy("doc_type").agg(
            F.sum("documents").alias("documents"), F.sum("chunks").alias("chunks"), F.min("first_date").alias("first_date"),
            F.max("last_date").alias("last_date"), F.max(F.col("documents") < 0).alias("touched"))
        touched = [r[0] for r in summed.where("touched").select("doc_type").collect()]  # one row per kind
        if touched:
            known = F.coalesce(F.col("doc_type").isin([t for t in touched if t is not None]), F.lit(None in touched))
            dates = self.documents().where(known).groupBy("doc_type").agg(F.min("meeting_date").alias("lo"), F.max("meeting_date").alias("hi"))
            summed = summed.join(dates.withColumnRenamed("doc_type", "of"), F.col("doc_type").eqNullSafe(F.col("of")), "left")
            summed = (summed.withColumn("first_date", F.when(F.col("touched"), F.col("lo")).otherwise(F.col("first_date")))
                      .withColumn("last_date", F.when(F.col("touched"), F.col("hi")).otherwise(F.col("last_date"))))
        return summed.where("documents > 0 or chunks > 0").select("doc_type", "documents", "chunks", "first_date", "last_date")

    def live_batches(self) -> list[str]:
        return [r[0] for r in self.commits().select("ingest_batch").collect()]  # one row per batch


class RunManifest:
    """Parameters and progress of runs, one appended row each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/manifest"

    def _rows(self) -> DataFrame:
        self.spark.createDataFrame([], schemas.MANIFEST).write.mode("ignore").json(self.path)
        return self.spark.read.schema(schemas.MANIFEST).json(self.path).where("run_name is not null")

    def save(self, **values) -> None:
        row = {name: values.get(name) for name in schemas.MANIFEST.names}
        frame = self.spark.createDataFrame([tuple(row.values())], schemas.MANIFEST)
        frame.withColumn("run_ts", F.current_timestamp()).write.mode("append").json(self.path)

    def latest(self, run_name: str) -> dict | None:
        """Newest readable row of a run; unreadable or discarded state counts as none."""
        row = self._rows().where(F.col("run_name") == run_name).orderBy(F.desc("run_ts")).first()
        return None if row is None or row["discarded"] else row.asDict()

    def discard(self, run_name: str) -> None:
        """Forget a run's parameters and progress; what it has stored stays."""
        self.save(run_name=run_name, discarded=True)

    def generation(self, run_name: str) -> int:
        """How often the run's state has been discarded."""
        return self._rows().where((F.col("run_name") == run_name) & F.col("discarded")).count()

    def check(self, run_name: str, **current) -> None:
        """Refuse to go on with other parameters than the run was started with."""
        stored = self.latest(run_name) or {}
        differing = [f"{k}: stored {json.dumps(stored[k])}, current {json.dumps(v)}"
                     for k, v in current.items() if stored.get(k) is not None and stored[k] != v]
        if differing:
            raise ValueError("run parameters differ from the stored run: " + "; ".join(differing)
                             + ". Discard the run or use a new name to start afresh.")
