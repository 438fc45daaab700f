"""Selections, joins, aggregates, keys, constraints and reports over documents and chunks."""

from datetime import date

from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold.functions.hashing import content_hash
from quirefold.functions.text import has_text, squeeze_ws, strip_ws
from quirefold.operators import dedup, quality, select
from quirefold.operators.chunking import window_chunks
from quirefold.operators.pages import assemble_pages, page_stats
from quirefold.plans import reports
from quirefold.suite.registry import query
from quirefold.suite.tables import CHUNKS, CONTENT_HASH, DOCS, OVERLAP, SIZE, SPACES, chunks, docs, table, window_sql

_SHORT_TITLE = "CASE WHEN length(title) > 51 THEN left(title, 50) || '...' ELSE title END"


# --- flagship -------------------------------------------------------------------------------------

@query(rf"""
WITH {DOCS},
firsts AS (SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY source_hash ORDER BY document_id) = 1),
cleaned AS (
  SELECT document_id, doc_type, meeting_date, title,
         trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), {SPACES}) AS text
  FROM firsts WHERE length(trim(text, {SPACES})) > 0),
{window_sql('cleaned', 'document_id')},
counted AS (SELECT document_id, count(DISTINCT {CONTENT_HASH}) AS distinct_chunks, count(*) AS n FROM chunks GROUP BY 1)
SELECT d.document_id, d.doc_type, d.meeting_date, coalesce(c.n, 0) AS chunks,
       coalesce(c.distinct_chunks, 0) AS distinct_chunks, {_SHORT_TITLE} AS title
FROM firsts d LEFT JOIN counted c USING (document_id)
ORDER BY meeting_date DESC NULLS LAST, document_id""")
def doc_overview(spark, sf):
    """Documents after first-wins de-duplication with their chunk counts, newest first.

    Texts cross one shuffle, the one that finds the first of each body; chunks are cut and hashed
    where their document lies.
    """
    d = docs(spark, sf)
    firsts = dedup.first_wins(d, ["document_id"])
    text = F.when(has_text(F.col("text")), strip_ws(squeeze_ws(F.col("text"))))
    cut = firsts.select("document_id", "doc_type", "meeting_date", "title", text.alias("text")).withColumn(
        "pieces", F.coalesce(window_chunks(F.col("text"), SIZE, OVERLAP), F.array().cast("array<string>")))
    hashes = F.transform("pieces", lambda p: content_hash(p, F.lit("window"), F.lit(SIZE), F.lit(OVERLAP)))
    return (cut.select("document_id", "doc_type", "meeting_date", F.size("pieces").cast("bigint").alias("chunks"),
                       F.size(F.array_distinct(hashes)).cast("bigint").alias("distinct_chunks"),
                       reports.short_title(F.col("title")).alias("title"))
            .orderBy(F.desc_nulls_last("meeting_date"), "document_id"))


# --- scans ----------------------------------------------------------------------------------------

@query(f"WITH {DOCS} SELECT document_id, url, title, doc_type, meeting_date, source_hash FROM docs")
def documents_scan(spark, sf):
    return docs(spark, sf).drop("text")


@query(f"""
WITH {DOCS}, {CHUNKS}
SELECT document_id, chunk_index, chunk_text, 'window' AS chunk_strategy, {SIZE} AS chunk_size,
       {OVERLAP} AS chunk_overlap, {CONTENT_HASH} AS content_hash
FROM chunks""")
def chunks_scan(spark, sf):
    return chunks(spark, sf)


@query(f"WITH {DOCS} SELECT DISTINCT source_hash FROM docs")
def known_hashes(spark, sf):
    return docs(spark, sf).select("source_hash").distinct()


# --- aggregates and reports -----------------------------------------------------------------------

@query(f"""
WITH {DOCS}, {CHUNKS}
SELECT 'documents' AS metric, count(*) AS n FROM docs UNION ALL SELECT 'chunks', count(*) FROM chunks""")
def stats_totals(spark, sf):
    return reports.totals(docs(spark, sf), chunks(spark, sf))


@query("SELECT lang AS doc_type, count(*) AS n FROM documents GROUP BY lang ORDER BY lang")
def docs_per_type(spark, sf):
    return reports.per_type(docs(spark, sf))


@query(f"WITH {DOCS} SELECT min(meeting_date) AS first_date, max(meeting_date) AS last_date FROM docs")
def date_span(spark, sf):
    return reports.date_span(docs(spark, sf))


@query(f"""
WITH {DOCS}, {CHUNKS}
SELECT 'documents' AS metric, '' AS key, CAST(count(*) AS VARCHAR) AS value FROM docs
UNION ALL SELECT 'first_date', '', CAST(min(meeting_date) AS VARCHAR) FROM docs
UNION ALL SELECT 'last_date', '', CAST(max(meeting_date) AS VARCHAR) FROM docs
UNION ALL SELECT 'documents_of_type', doc_type, CAST(count(*) AS VARCHAR) FROM docs GROUP BY doc_type
UNION ALL SELECT 'chunks', '', CAST(count(*) AS VARCHAR) FROM chunks""")
def stats_report(spark, sf):
    return reports.stats(docs(spark, sf), chunks(spark, sf))


@query(f"""
WITH {DOCS}, {CHUNKS}
SELECT d.document_id, d.doc_type, d.meeting_date, count(c.document_id) AS chunks, {_SHORT_TITLE} AS title
FROM docs d LEFT JOIN chunks c ON c.document_id = d.document_id AND length(trim(c.chunk_text, {SPACES})) > 0
GROUP BY d.document_id, d.doc_type, d.meeting_date, d.title
ORDER BY d.meeting_date DESC NULLS LAST, d.document_id""")
def list_docs(spark, sf):
    """List view; blank documents have no chunks."""
    return reports.list_documents(docs(spark, sf), chunks(spark, sf).where(has_text(F.col("chunk_text"))))


@query(f"WITH {DOCS}, {CHUNKS} SELECT document_id, count(*) AS chunks FROM chunks GROUP BY document_id")
def chunk_counts(spark, sf):
    return reports.chunk_counts(chunks(spark, sf))


@query(f"""
WITH {DOCS}, {CHUNKS}, wanted AS (SELECT max(document_id) AS id FROM docs)
SELECT d.document_id, d.doc_type, d.meeting_date, d.title, d.url, CAST(NULL AS INTEGER) AS page_count,
       CAST(NULL AS TIMESTAMP) AS ingested_at, c.chunk_index, {SIZE} AS chunk_size, 'window' AS chunk_strategy,
       left(c.chunk_text, 200) AS preview, length(c.chunk_text) >= 200 AS truncated
FROM docs d JOIN wanted ON d.document_id = id LEFT JOIN chunks c ON c.document_id = d.document_id
ORDER BY chunk_index""")
def show_doc(spark, sf):
    """The newest document by id, with previews of its chunks."""
    d = docs(spark, sf).withColumn("page_count", F.lit(None).cast("int")).withColumn(
        "ingested_at", F.lit(None).cast("timestamp_ntz"))
    newest = d.agg(F.max("document_id")).first()[0]
    return reports.show_document(d, chunks(spark, sf), newest)


@query(f"""
WITH {DOCS}, {CHUNKS}, wanted AS (SELECT max(document_id) AS id FROM docs)
SELECT d.document_id, d.title, d.doc_type, d.meeting_date,
       (SELECT count(*) FROM chunks c WHERE c.document_id = d.document_id) AS chunks
FROM docs d JOIN wanted ON d.document_id = id""")
def delete_preview(spark, sf):
    d = docs(spark, sf)
    newest = d.agg(F.max("document_id")).first()[0]
    return reports.delete_preview(d, chunks(spark, sf), newest)


@query(f"WITH {DOCS} SELECT document_id, meeting_date, doc_type FROM docs ORDER BY meeting_date DESC NULLS LAST, document_id")
def newest_first(spark, sf):
    """Global order of the list view."""
    return docs(spark, sf).select("document_id", "meeting_date", "doc_type").orderBy(
        F.desc_nulls_last("meeting_date"), "document_id")


@query(f"""
WITH {DOCS}, {CHUNKS}
SELECT document_id, chunk_index, left(chunk_text, 200) AS preview, length(chunk_text) >= 200 AS truncated,
       left(chunk_text, 300) AS search_preview, length(chunk_text) > 300 AS search_truncated
FROM chunks ORDER BY document_id, chunk_index""")
def chunk_previews(spark, sf):
    from quirefold.functions.text import is_truncated, preview
    text = F.col("chunk_text")
    return (chunks(spark, sf).select(
        "document_id", "chunk_index", preview(text).alias("preview"),
        is_truncated(text, at_limit=True).alias("truncated"),
        preview(text, fv.SEARCH_PREVIEW_CHARS).alias("search_preview"),
        is_truncated(text, fv.SEARCH_PREVIEW_CHARS).alias("search_truncated"))
        .orderBy("document_id", "chunk_index"))


@query(f"WITH {DOCS} SELECT document_id, {_SHORT_TITLE} AS title FROM docs")
def short_titles(spark, sf):
    return docs(spark, sf).select("document_id", reports.short_title(F.col("title")).alias("title"))


# --- selections -----------------------------------------------------------------------------------

@query(f"WITH {DOCS} SELECT document_id, doc_type FROM docs WHERE doc_type IN ('en', 'fr')")
def doc_type_select(spark, sf):
    return select.of_types(docs(spark, sf), ["en", "fr"]).select("document_id", "doc_type")


@query(f"""
WITH {DOCS} SELECT document_id, meeting_date FROM docs
WHERE meeting_date IS NULL OR meeting_date BETWEEN DATE '2000-06-01' AND DATE '2001-12-31'""")
def date_range_null_pass(spark, sf):
    return select.dated_within(docs(spark, sf), date(2000, 6, 1), date(2001, 12, 31)).select(
        "document_id", "meeting_date")


@query(f"""
SELECT conv_id, turn, text FROM conversations
WHERE length(trim(regexp_replace(text, '[^,]', ' ', 'g'), {SPACES})) > 0""")
def blank_drop(spark, sf):
    """Turns that keep a comma once every other character is blanked out; the rest counts as blank."""
    c = table(spark, sf, "conversations").withColumn("blanked", F.regexp_replace("text", "[^,]", " "))
    return select.not_blank(c, "blanked").select("conv_id", "turn", "text")


@query("SELECT doc_id AS document_id, strlen(text) AS bytes FROM documents WHERE strlen(text) <= 4000")
def oversize_guard(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(select.within_bytes(F.col("text"), 4000)).select(
        F.col("doc_id").alias("document_id"), F.octet_length("text").cast("bigint").alias("bytes"))


@query(f"""
WITH {DOCS} SELECT * EXCLUDE (text) FROM docs WHERE document_id = (SELECT min(document_id) FROM docs)""")
def point_lookup(spark, sf):
    d = docs(spark, sf).drop("text")
    return select.by_id(d, d.agg(F.min("document_id")).first()[0])


# --- de-duplication and keyed inserts -------------------------------------------------------------

@query(f"""
WITH {DOCS} SELECT document_id, source_hash, doc_type FROM docs
QUALIFY row_number() OVER (PARTITION BY source_hash ORDER BY document_id) = 1""")
def first_wins_dedup(spark, sf):
    d = docs(spark, sf).select("document_id", "source_hash", "doc_type")
    return dedup.first_wins(d, ["document_id"])


# Stored documents in the checks below: those that carry a label.
_STORED = "stored AS (SELECT d.* FROM docs d SEMI JOIN labels l ON d.document_id = l.doc_id)"


def _stored(spark, sf, d):
    return d.join(table(spark, sf, "labels").select(F.col("doc_id").alias("document_id")).distinct(),
                  "document_id", "left_semi")


@query(f"""
WITH {DOCS}, {_STORED}
SELECT document_id, source_hash FROM docs WHERE source_hash NOT IN (SELECT source_hash FROM stored)""")
def known_hash_skip(spark, sf):
    d = docs(spark, sf).select("document_id", "source_hash")
    return dedup.skip_known(d, _stored(spark, sf, d))


@query(f"""
WITH {DOCS}, {_STORED},
target AS (SELECT document_id, source_hash, url FROM stored
           QUALIFY row_number() OVER (PARTITION BY source_hash ORDER BY document_id) = 1)
SELECT document_id, source_hash, url FROM target
UNION ALL
(SELECT document_id, source_hash, url FROM docs WHERE source_hash NOT IN (SELECT source_hash FROM target)
 QUALIFY row_number() OVER (PARTITION BY source_hash ORDER BY document_id) = 1)""")
def insert_if_absent(spark, sf):
    d = docs(spark, sf).select("document_id", "source_hash", "url")
    target = dedup.first_wins(_stored(spark, sf, d), ["document_id"])
    return dedup.insert_if_absent(d, target, ["source_hash"], ["document_id"])


@query(f"""
WITH {DOCS}, {_STORED}, {CHUNKS},
hashed AS (SELECT document_id, chunk_index, {CONTENT_HASH} AS content_hash FROM chunks),
target AS (SELECT h.* FROM hashed h SEMI JOIN stored s USING (document_id))
SELECT * FROM target UNION ALL
SELECT DISTINCT * FROM (SELECT * FROM hashed UNION ALL SELECT * FROM target)
WHERE (document_id, chunk_index, content_hash) NOT IN (SELECT document_id, chunk_index, content_hash FROM target)""")
def chunk_insert_if_absent(spark, sf):
    """Chunks of all documents, some offered twice, into a table that has those of the labelled ones."""
    keys = ["document_id", "chunk_index", "content_hash"]
    hashed = chunks(spark, sf).select(*keys)
    target = _stored(spark, sf, hashed)
    return dedup.insert_if_absent(hashed.unionByName(target), target, keys)


@query(f"""
WITH {DOCS}, firsts AS (SELECT source_hash, min(document_id) AS id FROM docs GROUP BY source_hash)
SELECT d.document_id AS incoming_id, coalesce(f.id, d.document_id) AS document_id
FROM docs d LEFT JOIN firsts f ON d.source_hash = f.source_hash""")
def resolve_ids(spark, sf):
    d = docs(spark, sf).select("document_id", "source_hash")
    stored = d.groupBy("source_hash").agg(F.min("document_id").alias("document_id"))
    found = dedup.resolve_ids(d.withColumn("incoming_id", F.col("document_id")), stored)
    return found.select("incoming_id", "document_id")


@query(f"""
WITH {DOCS}, {CHUNKS}, gone AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)
SELECT 'documents' AS tab, document_id, CAST(NULL AS INTEGER) AS chunk_index FROM docs
WHERE document_id NOT IN (SELECT doc_id FROM gone)
UNION ALL SELECT 'chunks', document_id, chunk_index FROM chunks WHERE document_id NOT IN (SELECT doc_id FROM gone)""")
def cascade_delete(spark, sf):
    """What is left of both tables after deleting the documents labelled toxic."""
    gone = table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("document_id"))
    kept = dedup.remove_keys(docs(spark, sf).select("document_id"), gone)
    kept_chunks = dedup.remove_keys(chunks(spark, sf).select("document_id", "chunk_index"), gone)
    return (kept.select(F.lit("documents").alias("tab"), "document_id", F.lit(None).cast("int").alias("chunk_index"))
            .unionByName(kept_chunks.select(F.lit("chunks").alias("tab"), "document_id", "chunk_index")))


@query("""
SELECT 0 AS source_ord, doc_id AS item, text FROM documents
UNION ALL SELECT 1, item_id, text FROM benchmark
UNION ALL SELECT 2, conv_id * 1000 + turn, text FROM conversations""")
def union_sources(spark, sf):
    return dedup.concat_sources(
        table(spark, sf, "documents").select(F.col("doc_id").alias("item"), "text"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("item"), "text"),
        table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("item"), "text"))


# --- page texts -----------------------------------------------------------------------------------

_PAGES = """pages_of AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS page_no
  FROM documents)"""


def _pages(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("page_no", "text"))


@query(f"""
WITH {_PAGES}
SELECT doc_id, CAST(count(*) AS INTEGER) AS page_count,
       trim(string_agg(text, chr(10) ORDER BY page_no) FILTER (text <> ''), {SPACES}) AS text,
       CAST(NULL AS VARCHAR) AS error
FROM pages_of GROUP BY doc_id HAVING bool_or(length(trim(text, {SPACES})) > 0)""")
def page_assembly(spark, sf):
    """Lines of the documents taken as pages and put together again."""
    return assemble_pages(_pages(spark, sf), "doc_id")


@query(f"""
WITH {_PAGES}
SELECT doc_id, CAST(count(*) AS INTEGER) AS page_count, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes,
       bool_or(length(trim(text, {SPACES})) > 0) AS has_text
FROM pages_of GROUP BY doc_id""")
def page_counts(spark, sf):
    return page_stats(_pages(spark, sf), "doc_id")


# --- constraints ----------------------------------------------------------------------------------

@query(f"""
WITH {DOCS}, {CHUNKS},
d AS (SELECT document_id, url, CASE WHEN length(title) < 200 THEN title END AS title, doc_type, source_hash,
             DATE '2020-01-01' AS ingested_at FROM docs),
v AS (SELECT vec_id AS document_id, CASE WHEN label % 2 = 0 THEN embedding ELSE embedding[1:32] END AS embedding FROM embeddings),
c AS (SELECT document_id + 7 AS document_id, chunk_index % 50 AS chunk_index FROM chunks)
SELECT 'not_null:title' AS rule, CAST(document_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n FROM d WHERE title IS NULL
UNION ALL SELECT 'in_set:doc_type', CAST(document_id AS VARCHAR), 1 FROM d WHERE doc_type NOT IN ('en', 'fr', 'de')
UNION ALL SELECT 'unique:source_hash', source_hash, count(*) FROM d GROUP BY source_hash HAVING count(*) > 1
UNION ALL SELECT 'unique:document_id,chunk_index', concat_ws('|', document_id, chunk_index), count(*) FROM c
          GROUP BY document_id, chunk_index HAVING count(*) > 1
UNION ALL SELECT 'references:document_id', CAST(document_id AS VARCHAR), count(*) FROM c
          WHERE document_id NOT IN (SELECT document_id FROM d) GROUP BY document_id
UNION ALL SELECT 'dims:embedding', CAST(document_id AS VARCHAR), 1 FROM v WHERE len(embedding) <> 64""")
def violations(spark, sf):
    """All constraint checks over tables that break them: long titles taken away, chunks hung on other documents, shortened vectors."""
    d = docs(spark, sf).select(
        "document_id", "url", F.when(F.length("title") < 200, F.col("title")).alias("title"), "doc_type",
        "source_hash", F.lit("2020-01-01").cast("date").alias("ingested_at"))
    v = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("document_id"),
        F.when(F.col("label") % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 32)).alias("embedding"))
    c = chunks(spark, sf).select((F.col("document_id") + 7).alias("document_id"), (F.col("chunk_index") % 50).alias("chunk_index"))
    required = ["url", "title", "doc_type", "ingested_at", "source_hash"]
    return (quality.row_violations(d, quality.row_rules(required, {"doc_type": ["en", "fr", "de"]}), "document_id")
            .unionByName(quality.unique_violations(d, ["source_hash"]))
            .unionByName(quality.unique_violations(c, ["document_id", "chunk_index"]))
            .unionByName(quality.orphan_violations(c, d))
            .unionByName(quality.row_violations(v, quality.row_rules(dims={"embedding": 64}), "document_id")))
