"""Scalar text functions, HTML, dates, hashes and chunking.

The test texts hold no printing artefacts, so the cleaning checks put some in, the same way in
Spark and in SQL. SQL patterns are the fixed ones in RE2 spelling.
"""

from datetime import date

from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold import schemas
from quirefold.functions import text as tx
from quirefold.functions.dates import parse_date
from quirefold.operators.chunking import cap_chunks, chunk_documents, chunk_rows, merge_tail, window_chunks
from quirefold.plans.ingest import IngestOptions, ingest_batch, retry_waiting
from quirefold.plans.resolve import Incoming, resolve
from quirefold.plans.resolve import plan_ingest as plan
from quirefold.sources.landing import body_key, detail_items, listing_items
from quirefold.sources.shared import shared_path
from quirefold.sources.store import DocumentStore
from quirefold.suite.registry import query
from quirefold.suite.tables import (CHUNKS, CONTENT_HASH, DOCS, OVERLAP, SIZE, SPACES, chunks, docs, estimate_sql,
                                    table, window_sql)


def _texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


# (what is replaced, by what): artefacts put into the texts.
_ARTEFACTS = {
    " a": "­ a", " e": "​ e", "fi": "ﬁ", "st": "ﬆ", " de ": " de ",
    " the ": " th-\ne ", " la ": " l-\na ", ". ": ".\nPágina 3 de 19 \nCopom - 12ª Reunião\n",
    ", ": ",\n 7 \n12\n", " in ": "  \t in ", " le ": "\n\n\n\nle ", " of ": " www.bcb.gov.br\n",
    " of": " Banco Central do Brasil \nof", "et ": "Ata da 5a Reunião do Copom\n",
}


def _put(c, artefacts):
    for plain, artefact in artefacts.items():
        c = F.replace(c, F.lit(plain), F.lit(artefact))
    return c


def _sql_string(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _put_sql(c: str, artefacts) -> str:
    for plain, artefact in artefacts.items():
        c = f"replace({c}, {_sql_string(plain)}, {_sql_string(artefact)})"
    return c


def _pick(*keys):
    return {k: _ARTEFACTS[k] for k in keys}


def _regex(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {_sql_string(pattern)}, {_sql_string(by)}, 'g')"


def _squeeze_sql(c: str) -> str:
    return _regex(_regex(c, r"[ \t]+", " "), r"\n{3,}", "\n\n")


# Fixed values written out for the SQL, apart from those that the code uses.
_BOILERPLATE_RE2 = (
    r"(?i)Banco Central do Brasil\s*\n",
    r"(?i)Copom\s*[-–]\s*\d+[ªa]?\s*Reunião\s*\n",
    r"(?i)Ata da?\s+\d+[ªa]?\s+Reunião do Copom\s*\n",
    r"(?i)\bwww\.bcb\.gov\.br\b\s*\n",
    r"(?i)Página \d+ de \d+\s*\n",
    r"(?m)^\s*\d+\s*$",
)


def _boilerplate_sql(c: str) -> str:
    for pattern in _BOILERPLATE_RE2:
        c = _regex(c, pattern)
    return c


def clean_sql(c: str) -> str:
    """The whole cleaning chain, for texts whose only characters NFKC changes are the artefacts'."""
    for char in fv.INVISIBLE_CHARS:
        c = f"replace({c}, chr({ord(char)}), '')"
    for char, plain in (("ﬁ", "fi"), ("ﬆ", "st"), (" ", " "), ("ª", "a")):
        c = f"replace({c}, {_sql_string(char)}, {_sql_string(plain)})"
    return f"trim({_squeeze_sql(_regex(_boilerplate_sql(c), '-' + chr(10) + r'(\S)', r'\1'))}, {SPACES})"


def _each(spark, sf, artefacts, function, name="text"):
    """One text function over all documents with artefacts put in."""
    put = _texts(spark, sf).withColumn("text", _put(F.col("text"), artefacts))
    return put.select("doc_id", function(F.col("text")).alias(name))


# --- cleaning -------------------------------------------------------------------------------------

@query(f"SELECT doc_id, replace(replace({_put_sql('text', _pick(' a', ' e'))}, chr(173), ''), chr(8203), '') AS text FROM documents")
def remove_invisible(spark, sf):
    return _each(spark, sf, _pick(" a", " e"), tx.remove_invisible)


@query(f"SELECT doc_id, replace(replace({_put_sql('text', _pick('fi', 'st'))}, chr(64257), 'fi'), chr(64262), 'st') AS text FROM documents")
def expand_ligatures(spark, sf):
    return _each(spark, sf, _pick("fi", "st"), tx.expand_ligatures)


@query(f"""SELECT doc_id, replace(replace(replace({_put_sql('text', _pick('fi', 'st', ' de '))},
  chr(64257), 'fi'), chr(64262), 'st'), chr(160), ' ') AS text FROM documents""")
def nfkc(spark, sf):
    return _each(spark, sf, _pick("fi", "st", " de "), tx.nfkc)


@query(f"SELECT doc_id, {_boilerplate_sql(_put_sql('text', _pick('. ', ', ', ' of ', ' of', 'et ')))} AS text FROM documents")
def drop_boilerplate(spark, sf):
    return _each(spark, sf, _pick(". ", ", ", " of ", " of", "et "), tx.drop_boilerplate)


@query(f"SELECT doc_id, {_regex(_put_sql('text', _pick(' the ', ' la ')), '-' + chr(10) + r'(\S)', r'\1')} AS text FROM documents")
def dehyphenate(spark, sf):
    return _each(spark, sf, _pick(" the ", " la "), tx.dehyphenate)


@query(f"SELECT doc_id, {_squeeze_sql(_put_sql('text', _pick(' in ', ' le ')))} AS text FROM documents")
def squeeze_ws(spark, sf):
    return _each(spark, sf, _pick(" in ", " le "), tx.squeeze_ws)


@query(f"SELECT doc_id, trim(' ' || chr(10) || text || chr(9), {SPACES}) AS text FROM documents")
def strip_ws(spark, sf):
    return _texts(spark, sf).select("doc_id", tx.strip_ws(F.concat(F.lit(" \n"), "text", F.lit("\t"))).alias("text"))


@query(f"SELECT doc_id, {clean_sql(_put_sql('text', _ARTEFACTS))} AS text FROM documents")
def clean_text(spark, sf):
    return _each(spark, sf, _ARTEFACTS, tx.clean_text)


@query(f"SELECT doc_id, CAST({estimate_sql('text')} AS INTEGER) AS tokens FROM documents")
def token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.token_estimate(F.col("text")).alias("tokens"))


# --- HTML -----------------------------------------------------------------------------------------

def _html_sql(c: str) -> str:
    for tag in ("script", "style"):
        c = f"regexp_replace({c}, '<{tag}[^>]*>.*?</{tag}>', '', 'gis')"
    c = f"regexp_replace({c}, '<(br|p|div|h[1-6]|li|tr)[^>]*>', chr(10), 'gi')"
    c = _regex(c, "<[^>]+>")
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&nbsp;", "chr(160)"),
                         ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        c = f"replace({c}, '{entity}', {char})"
    return f"trim({_squeeze_sql(c)}, {SPACES})"


@query(f"SELECT page_id, {_html_sql('html')} AS text FROM pages")
def html_to_text(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", tx.html_to_text(F.col("html")).alias("text"))


@query("""SELECT page_id, replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)),
  '&amp;', '&') || ' ' || chr(233) || chr(8364) || '&lt;' AS text FROM pages""")
def unescape_entities(spark, sf):
    """Every page gets entities the JVM path does not know, so all go through the full decoder."""
    pages = table(spark, sf, "pages")
    more = F.concat("html", F.lit(" &eacute;&#x20AC;&amp;lt;"))
    return pages.select("page_id", tx.unescape_entities(more).alias("text"))


# --- dates ----------------------------------------------------------------------------------------

# A date per document, written in one of six ways; the last two are not dates.
_WRITTEN = """CASE doc_id % 6
  WHEN 0 THEN strftime(d, '%Y-%m-%dT10:20:30Z') WHEN 1 THEN strftime(d, '%Y-%m-%d') WHEN 2 THEN strftime(d, '%d/%m/%Y')
  WHEN 3 THEN strftime(d, '%Y-%m-%d 10:20') WHEN 4 THEN strftime(d, '%Y-%m-') || '99' ELSE strftime(d, '%y-%m-%d') END"""
_DATES = "dates AS (SELECT doc_id, DATE '2000-01-01' + CAST(doc_id % 5000 AS INTEGER) AS d FROM documents)"


def _written(doc_id=None):
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    d = F.date_add(F.lit("2000-01-01").cast("date"), (doc_id % 5000).cast("int"))
    ways = ("yyyy-MM-dd'T10:20:30Z'", "yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM-dd' 10:20'", "yyyy-MM-'99'", "yy-MM-dd")
    c = F.when(F.lit(False), F.lit(""))
    for i, way in enumerate(ways):
        c = c.when(doc_id % 6 == i, F.date_format(d, way))
    return c


@query(f"""
WITH {_DATES}, written AS (SELECT doc_id, {_WRITTEN} AS raw FROM dates)
SELECT doc_id, raw, CASE WHEN regexp_matches(raw, '^[0-9]{{4}}-|/[0-9]{{4}}$') THEN CAST(coalesce(
         try_strptime(left(raw, 19), '%Y-%m-%dT%H:%M:%S'), try_strptime(left(raw, 10), '%Y-%m-%d'),
         try_strptime(left(raw, 10), '%d/%m/%Y')) AS DATE) END AS parsed
FROM written""")
def parse_dates(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", _written().alias("raw"))
    return d.withColumn("parsed", parse_date(F.col("raw")))


# --- hashes ---------------------------------------------------------------------------------------

@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN sha256(text) WHEN doc_id % 3 = 1 THEN sha256(html) ELSE '' END AS source_hash "
       "FROM (SELECT doc_id, text, '<p>' || text AS html FROM documents)")
def source_hash(spark, sf):
    """A third with bytes, a third with text only, a third with neither."""
    from quirefold.functions.hashing import source_hash as hashed
    d = _texts(spark, sf)
    raw_bytes = F.when(F.col("doc_id") % 3 == 0, F.encode("text", "UTF-8"))
    raw_text = F.when(F.col("doc_id") % 3 != 2, F.concat(F.lit("<p>"), "text"))
    return d.select("doc_id", hashed(raw_bytes, raw_text).alias("source_hash"))


@query(f"WITH {DOCS}, {CHUNKS} SELECT document_id, chunk_index, {CONTENT_HASH} AS content_hash FROM chunks")
def content_hash(spark, sf):
    return chunks(spark, sf).select("document_id", "chunk_index", "content_hash")


@query(f"WITH {DOCS} SELECT document_id, CAST('0x' || substr(source_hash, 1, 15) AS BIGINT) AS stored_id FROM docs")
def hash_ids(spark, sf):
    from quirefold.functions.hashing import document_id
    return docs(spark, sf).select("document_id", document_id(F.col("source_hash")).alias("stored_id"))


# --- chunking -------------------------------------------------------------------------------------

@query(f"WITH {DOCS}, {CHUNKS} SELECT document_id, chunk_index, chunk_text FROM chunks")
def chunk_window(spark, sf):
    return chunks(spark, sf).select("document_id", "chunk_index", "chunk_text")


_MERGED = f"""numbered AS (
  SELECT *, count(*) OVER (PARTITION BY document_id) AS n,
         lead(chunk_text) OVER (PARTITION BY document_id ORDER BY chunk_index) AS following FROM chunks),
merged AS (
  SELECT document_id, chunk_index,
         CASE WHEN chunk_index = n - 2 AND {estimate_sql('following')} < 75 THEN chunk_text || ' ' || following
              ELSE chunk_text END AS chunk_text
  FROM numbered WHERE NOT (n > 1 AND chunk_index = n - 1 AND {estimate_sql('chunk_text')} < 75))"""


def _arrays(spark, sf):
    return _texts(spark, sf).select(F.col("doc_id").alias("document_id"),
                                    window_chunks(F.col("text"), SIZE, OVERLAP).alias("pieces"))


@query(f"WITH {DOCS}, {CHUNKS}, {_MERGED} SELECT document_id, chunk_index, chunk_text FROM merged")
def merge_tail_chunks(spark, sf):
    merged = _arrays(spark, sf).withColumn("pieces", merge_tail(F.col("pieces"), SIZE, 0.75))
    return merged.select("document_id", F.posexplode("pieces").alias("chunk_index", "chunk_text"))


@query(f"WITH {DOCS}, {CHUNKS}, {_MERGED} SELECT document_id, chunk_index, chunk_text FROM merged WHERE chunk_index < 8")
def cap_chunks_per_doc(spark, sf):
    """The per-document cap of the chunker, after the merge."""
    merged = _arrays(spark, sf).withColumn("pieces", merge_tail(F.col("pieces"), SIZE, 0.75))
    return merged.select("document_id", F.posexplode(cap_chunks(F.col("pieces"), 8)).alias("chunk_index", "chunk_text"))


@query(f"""
WITH {DOCS}, cleaned AS (SELECT document_id, {clean_sql('text')} AS text FROM docs),
usable AS (SELECT * FROM cleaned WHERE length(text) > 0 AND strlen(text) <= 60000),
{window_sql('usable', 'document_id')}, {_MERGED}
SELECT document_id, chunk_index, chunk_text, chunk_text AS cleaned_text, 'window' AS chunk_strategy, {SIZE} AS chunk_size,
       {OVERLAP} AS chunk_overlap, {CONTENT_HASH} AS content_hash
FROM merged""")
def chunk_rows_built(spark, sf):
    """Clean, chunk with all guards, attach parameters and hash."""
    d = _texts(spark, sf).select(F.col("doc_id").alias("document_id"), tx.clean_text(F.col("text")).alias("text"))
    pieces = chunk_documents(d, "text", "window", SIZE, OVERLAP, 0.75, max_bytes=60000)
    return chunk_rows(pieces, "window", SIZE, OVERLAP)


@query()
def chunk_recursive(spark, sf):
    """Recursive chunking of all documents with the default parameters."""
    d = _texts(spark, sf).select(F.col("doc_id").alias("document_id"), tx.clean_text(F.col("text")).alias("text"))
    return chunk_documents(d)


@query(rf"SELECT doc_id AS document_id, sha256(regexp_replace({clean_sql('text')}, '\s+', '', 'g')) AS letters FROM documents "
       f"WHERE length(trim(text, {SPACES})) > 0")
def chunk_recursive_lossless(spark, sf):
    """Recursive chunks without overlap, put together again: white space aside, nothing is lost or repeated."""
    d = _texts(spark, sf).select(F.col("doc_id").alias("document_id"), tx.clean_text(F.col("text")).alias("text"))
    pieces = chunk_documents(d, size=60, overlap=0, max_chunks=2 ** 31 - 1)
    whole = pieces.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text"))).alias("c"))
    joined = F.array_join(F.transform("c", lambda x: x["chunk_text"]), "")
    return whole.select("document_id", F.sha2(F.regexp_replace(joined, r"\s+", ""), 256).alias("letters"))


@query(f"SELECT doc_id AS document_id, CAST(0 AS BIGINT) AS oversized, CAST(0 AS BIGINT) AS gaps FROM documents "
       f"WHERE length(trim({clean_sql('text')}, {SPACES})) > 0")
def chunk_recursive_bounds(spark, sf):
    """No chunk but a merged last one is larger than the size, and chunks are numbered without gaps."""
    d = _texts(spark, sf).select(F.col("doc_id").alias("document_id"), tx.clean_text(F.col("text")).alias("text"))
    pieces = chunk_documents(d, size=60, overlap=10, max_chunks=2 ** 31 - 1)
    n, last = F.count("*"), F.max("chunk_index") + 1
    over = F.count_if(tx.token_estimate(F.col("chunk_text")) > 60)
    last_over = F.max_by(tx.token_estimate(F.col("chunk_text")) > 60, "chunk_index").cast("long")
    merged = F.max_by(tx.token_estimate(F.col("chunk_text")) <= 91, "chunk_index")  # 60, a blank, and less than 30
    return pieces.groupBy("document_id").agg((over - F.when(merged, last_over).otherwise(0)).alias("oversized"), (last - n).alias("gaps"))


# --- listings, details and bodies -----------------------------------------------------------------

# Each document is listed by one payload. English ones are of the first kind.
_KIND = "CASE WHEN lang = 'en' THEN 'ata' ELSE 'comunicado' END"


def _base(spark, sf):
    kind = F.when(F.col("lang") == "en", fv.DOC_TYPES[0]).otherwise(fv.DOC_TYPES[1])
    return table(spark, sf, "documents").withColumn("kind", kind)


def _listing(base, land=lambda df: df, broken="false"):
    """Payloads as they would be landed, written and read as JSON; some fields are left out, some payloads cut off."""
    number = F.col("doc_id").cast("int")
    item = F.struct(
        _written().alias("dataReferencia"),
        F.when(F.col("doc_id") % 4 != 0, number).alias("nroReuniao"),
        F.when(F.col("doc_id") % 4 == 0, number).alias("nro_reuniao"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit(" "), F.col("source"), F.lit(" "))).alias("titulo"))
    body = F.to_json(F.struct(F.array(item).alias("conteudo")))
    payload = base.select("kind", F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("list_file"),
                          F.when(~F.expr(broken), F.from_json(body, schemas.LISTING)).alias("p"),
                          F.when(F.expr(broken), F.substring(body, 1, 20)).alias("broken")).select("kind", "list_file", "p.conteudo", "broken")
    payload = land(payload)
    first, second = (listing_items(payload.where(F.col("kind") == t), t) for t in fv.DOC_TYPES)
    return first.unionByName(second)


def _number(x):
    return f"CAST({x} AS INTEGER)"


_LISTED = f"""dates AS (SELECT *, DATE '2000-01-01' + CAST(doc_id % 5000 AS INTEGER) AS d FROM documents),
listed AS (
  SELECT doc_id, {_KIND} AS doc_type, {_number('doc_id')} AS meeting_number, text,
         CASE WHEN doc_id % 6 < 4 THEN d END AS meeting_date,
         CASE WHEN doc_id % 5 <> 0 THEN source
              ELSE CASE WHEN lang = 'en' THEN 'Ata ' ELSE 'Comunicado ' END || doc_id END AS title
  FROM dates)"""


_BROKEN = "doc_id % 13 = 0"


@query(f"""
WITH {_LISTED} SELECT CASE doc_type WHEN 'ata' THEN 0 ELSE 1 END AS source_ord, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS list_file,
  CAST(CASE WHEN {_BROKEN} THEN -1 ELSE 0 END AS BIGINT) AS list_pos, doc_type,
  CASE WHEN {_BROKEN} THEN CAST(-1 AS INTEGER) ELSE meeting_number END AS meeting_number,
  CASE WHEN {_BROKEN} THEN lpad(CAST(doc_id AS VARCHAR), 12, '0') ELSE title END AS title,
  CASE WHEN {_BROKEN} THEN NULL ELSE meeting_date END AS meeting_date,
  CASE WHEN {_BROKEN} THEN 'listing payload cannot be read' END AS list_error FROM listed""")
def listing_source(spark, sf):
    """Listed documents; a payload that is cut off gives one row that says so."""
    return _listing(_base(spark, sf), broken=_BROKEN)


@query(f"""
WITH {_LISTED} SELECT doc_type, meeting_number, title, meeting_date FROM listed
WHERE doc_type = 'ata' AND (meeting_date IS NULL OR meeting_date BETWEEN DATE '2000-03-01' AND DATE '2002-03-01')""")
def plan_ingest(spark, sf):
    """Dry run over one kind and a date range."""
    return plan(_listing(_base(spark, sf)), ["ata"], date(2000, 3, 1), date(2002, 3, 1))


def _detail(base, land=lambda df: df):
    """Details: of the first kind two thirds name a PDF, relative or absolute; texts come as HTML or not at all."""
    n = F.col("doc_id")
    pdf = F.when(n % 3 == 0, F.concat(F.lit(" /pdf/"), n.cast("string"), F.lit(".pdf"))).when(
        n % 3 == 1, F.concat(F.lit("https://files.example/"), n.cast("string"), F.lit(".pdf")))
    html = F.when(n % 7 != 0, F.concat(F.lit("<div><p>"), F.col("text"), F.lit("</p></div>"))).when(n % 2 == 0, F.lit("  "))
    item = F.struct(pdf.alias("urlPdfAta"), html.alias("textoAta"), html.alias("textoComunicado"))
    body = F.to_json(F.struct(F.when(n % 11 != 0, F.array(item)).otherwise(F.array()).alias("conteudo")))
    payload = base.select("kind", n.cast("int").alias("meeting_number"), F.from_json(body, schemas.DETAIL).alias("p")).select(
        "kind", "meeting_number", "p.conteudo")
    payload = land(payload)
    first, second = (detail_items(payload.where(F.col("kind") == t), t) for t in fv.DOC_TYPES)
    return first.unionByName(second)


_FOUND = f"""{_LISTED},
detail AS (
  SELECT *, CASE WHEN doc_type = 'ata' AND doc_id % 11 <> 0 THEN
              CASE doc_id % 3 WHEN 0 THEN '{fv.BASE_URL}/pdf/' || doc_id || '.pdf'
                              WHEN 1 THEN 'https://files.example/' || doc_id || '.pdf' ELSE '' END ELSE '' END AS pdf_url,
         CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN
              trim({_squeeze_sql(_regex("regexp_replace(chr(10) || chr(10) || text, '<(br|p|div|h[1-6]|li|tr)[^>]*>', chr(10), 'gi')", '<[^>]+>'))}, {SPACES})
         END AS html_text
  FROM listed),
body AS (
  SELECT *, pdf_url <> '' AND doc_id % 2 = 0 AS is_pdf, html_text IS NOT NULL AND NOT (pdf_url <> '' AND doc_id % 2 = 0) AS is_html
  FROM detail)"""


@query(f"""
WITH {_LISTED}
SELECT doc_type, meeting_number,
  CASE WHEN doc_type = 'ata' AND doc_id % 11 <> 0 THEN
    CASE doc_id % 3 WHEN 0 THEN '{fv.BASE_URL}/pdf/' || doc_id || '.pdf'
                    WHEN 1 THEN 'https://files.example/' || doc_id || '.pdf' ELSE '' END ELSE '' END AS pdf_url,
  CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN '<div><p>' || text || '</p></div>' ELSE '' END AS html
FROM listed""")
def detail_source(spark, sf):
    return _detail(_base(spark, sf))


@query(f"""
WITH {_FOUND}
SELECT CASE doc_type WHEN 'ata' THEN 0 ELSE 1 END AS source_ord, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS list_file,
  CAST(0 AS BIGINT) AS list_pos,
  CASE WHEN is_pdf THEN pdf_url WHEN doc_type = 'ata'
       THEN '{fv.DETAIL_URLS['ata']}' || meeting_number
       ELSE '{fv.DETAIL_URLS['comunicado']}' || meeting_number END AS url,
  title, doc_type, meeting_date, meeting_number,
  CASE WHEN is_pdf THEN sha256('pdf ' || text) WHEN is_html AND length(html_text) > 0 THEN sha256(html_text) ELSE '' END AS source_hash,
  CASE WHEN is_pdf THEN CAST(len(string_split(text, chr(10))) AS INTEGER) END AS page_count,
  CASE WHEN is_pdf THEN length(trim(text, {SPACES})) > 0 ELSE is_html AND length(html_text) > 0 END AS has_text,
  CASE WHEN is_pdf THEN trim({_regex('text', chr(10) + '{2,}', chr(10))}, {SPACES}) WHEN is_html THEN html_text END AS text,
  CASE WHEN NOT is_pdf AND NOT is_html THEN 'no body' END AS error
FROM body""")
def resolve_bodies(spark, sf):
    """Listing joined to details, bodies and pages; PDF, HTML or no body decided per document.

    The payloads, bodies and pages are derived from the documents and landed as tables first.
    """
    def land(df):
        path = shared_path(spark, "landed")
        df.write.parquet(path)
        return spark.read.parquet(path)

    base = _base(spark, sf)
    incoming = resolve(_listing(base, land), *_landed_parts(base, land))
    # As an ingest batch does: write the narrow part down, then read texts for it.
    return Incoming(land(incoming.narrow), incoming.texts).with_texts().drop("from_pages", "oversize")


def _landed_parts(base, land):
    """Details, bodies and pages derived from the documents."""
    detail = _detail(base, land)
    with_pdf = detail.where("pdf_url <> '' and meeting_number % 2 = 0").select(
        F.col("meeting_number").cast("bigint").alias("doc_id"), body_key(F.col("pdf_url")).alias("doc_key"))
    landed = base.select("doc_id", "text").join(with_pdf, "doc_id")
    bodies = land(landed.select("doc_id", "doc_key", F.sha2(F.concat(F.lit("pdf "), "text"), 256).alias("body_hash")))
    pages = land(landed.select("doc_key", F.posexplode(F.split("text", "\n")).alias("page_no", "text")))
    return detail, bodies.drop("doc_id"), pages


@query(f"""
WITH {_FOUND}
SELECT DISTINCT 'documents' AS tab, CASE WHEN is_pdf THEN sha256('pdf ' || text) ELSE sha256(html_text) END AS what, CAST(NULL AS VARCHAR) AS error
FROM body WHERE CASE WHEN is_pdf THEN length(trim(text, {SPACES})) > 0 ELSE is_html AND length(html_text) > 0 END
UNION ALL SELECT 'quarantine', doc_type || ' ' || meeting_number, 'no body' FROM body WHERE NOT is_pdf AND NOT is_html
UNION ALL SELECT 'first wave', doc_type || ' ' || meeting_number, 'no body' FROM body
  WHERE doc_id % 3 = 0 OR NOT is_html AND (NOT is_pdf OR doc_id % 7 = 0)""")
def late_bodies(spark, sf):
    """Listings land first; a third of the details and every body without an HTML text beside it land later. The
    documents wait in quarantine and are taken by the next run, from there and not from the listings."""
    def land(df):
        path = shared_path(spark, "landed")
        df.write.parquet(path)
        return spark.read.parquet(path)

    base = _base(spark, sf)
    listing, (detail, bodies, pages) = _listing(base, land), _landed_parts(base, land)
    late = detail.where((F.col("meeting_number") % 7 == 0) & (F.col("pdf_url") != "")).select(body_key(F.col("pdf_url")).alias("doc_key"))
    early = resolve(listing, detail.where("meeting_number % 3 <> 0"), bodies.join(late, "doc_key", "left_anti"), pages)
    store, options = DocumentStore(spark, shared_path(spark, "store")).create(), IngestOptions(strategy="window", provider_options={"dims": 8})
    ingest_batch(store, early, options, "daily", "0")
    name = F.concat_ws(" ", "doc_type", F.col("meeting_number").cast("string")).alias("what")
    waited = land(store.read("quarantine").select(F.lit("first wave").alias("tab"), name, "error"))
    retry_waiting(store, lambda rows: resolve(rows, detail, bodies, pages), options, "daily")
    stored = store.documents().select(F.lit("documents").alias("tab"), F.col("source_hash").alias("what"), F.lit(None).cast("string").alias("error"))
    return stored.unionByName(store.read("quarantine").select(F.lit("quarantine").alias("tab"), name, "error")).unionByName(waited)
