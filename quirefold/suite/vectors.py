"""Vector functions, exact and approximate nearest neighbours, embeddings and search."""

from pyspark.sql import functions as F

from quirefold.functions import vectors as vx
from quirefold.operators import cells
from quirefold.operators.embedding import embed
from quirefold.operators.topk import batch_top_k, rank, top_k
from quirefold.plans import reports
from quirefold.sources.shared import shared_path
from quirefold.suite.registry import query
from quirefold.suite.tables import CHUNKS, DOCS, chunks, docs, table

DIMS = 64
_SIM = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


def _query_vector(spark, sf):
    """The query of the single searches: the vector with the lowest id."""
    return list(_vectors(spark, sf).orderBy("vec_id").first()["embedding"])


_QUERY = "q AS (SELECT embedding AS query FROM embeddings ORDER BY vec_id LIMIT 1)"


# --- scalars --------------------------------------------------------------------------------------

@query(f"""
SELECT vec_id, round({_SIM.format(a='embedding', b='list_reverse(embedding)')}, 6) AS similarity,
       round(1 - {_SIM.format(a='embedding', b='list_reverse(embedding)')}, 6) AS distance FROM embeddings""")
def cosine(spark, sf):
    """Similarity of each vector to its own reverse, in the JVM."""
    similarity = vx.cosine_similarity(F.col("embedding"), F.reverse("embedding"))
    return _vectors(spark, sf).select("vec_id", F.round(similarity, 6).alias("similarity"),
                                      F.round(1 - similarity, 6).alias("distance"))


@query("""
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(embedding[pos] AS DOUBLE), 6) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""")
def vector_literal(spark, sf):
    """Vectors written as literals and parsed back."""
    back = vx.parse_literal(vx.to_literal(F.col("embedding")))
    return (_vectors(spark, sf).select("vec_id", F.posexplode(back).alias("pos", "value"))
            .withColumn("value", F.round(F.col("value").cast("double"), 6)))


@query("""
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(CAST(CAST(embedding[pos] AS DOUBLE) / 3 AS FLOAT) AS DOUBLE), 6) AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""")
def narrow_float32(spark, sf):
    third = F.transform(F.col("embedding").cast("array<double>"), lambda x: x / 3)
    return (_vectors(spark, sf).select("vec_id", F.posexplode(vx.narrow(third)).alias("pos", "value"))
            .withColumn("value", F.round(F.col("value").cast("double"), 6)))


@query("""
WITH head AS (SELECT vec_id, CAST(embedding[1:32] AS DOUBLE[]) AS v FROM embeddings),
norms AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM head)
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(CAST(v[pos] / norm AS FLOAT) AS DOUBLE), 5) AS value
FROM (SELECT vec_id, v, norm, unnest(range(1, 33)) AS pos FROM norms)""")
def truncate_dims(spark, sf):
    """First half of every vector, scaled back to unit length."""
    head = vx.truncate_dims(F.col("embedding"), 32, renormalise=True)
    return (_vectors(spark, sf).select("vec_id", F.posexplode(head).alias("pos", "value"))
            .withColumn("value", F.round(F.col("value").cast("double"), 5)))


# --- exact top-k ----------------------------------------------------------------------------------

@query(f"""
WITH {_QUERY}, scored AS (SELECT vec_id, label, {_SIM.format(a='embedding', b='query')} AS s FROM embeddings, q),
best AS (SELECT * FROM scored ORDER BY round(s, 9) DESC NULLS LAST, vec_id LIMIT 10)
SELECT vec_id, label, round(s, 6) AS similarity,
       CAST(row_number() OVER (ORDER BY round(s, 9) DESC NULLS LAST, vec_id) AS INTEGER) AS rank FROM best""")
def topk_cosine(spark, sf):
    v = _vectors(spark, sf)
    best = top_k(v, _query_vector(spark, sf), 10, keys=["vec_id"])
    return rank(best, ["vec_id"]).withColumn("similarity", F.round("similarity", 6))


@query(f"""
WITH {_QUERY}, scored AS (SELECT vec_id, label, {_SIM.format(a='embedding', b='query')} AS s FROM embeddings, q WHERE label = 3)
SELECT vec_id, label, round(s, 6) AS similarity FROM scored ORDER BY round(s, 9) DESC NULLS LAST, vec_id LIMIT 10""")
def topk_facet(spark, sf):
    """Facet filter before the limit."""
    v = _vectors(spark, sf).where("label = 3")
    best = top_k(v, _query_vector(spark, sf), 10, keys=["vec_id"])
    return best.withColumn("similarity", F.round("similarity", 6))


_BATCH = f"""
WITH scored AS (SELECT a.vec_id AS query_id, b.vec_id, {_SIM.format(a='a.embedding', b='b.embedding')} AS s
                FROM embeddings a, embeddings b),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC NULLS LAST, vec_id) AS INTEGER) AS rank
           FROM scored)
SELECT query_id, vec_id, round(s, 6) AS similarity, rank FROM ranked WHERE rank <= 10"""


def _queries(spark, sf):
    return _vectors(spark, sf).select(F.col("vec_id").alias("query_id"), "embedding")


@query(_BATCH)
def topk_batch(spark, sf):
    """The ten nearest vectors of every vector."""
    v = _vectors(spark, sf)
    found = batch_top_k(v, _queries(spark, sf), 10, keys=["vec_id"])
    return found.withColumn("similarity", F.round("similarity", 6))


@query(_BATCH)
def topk_batch_blocks(spark, sf):
    """The same with a query set that takes several blocks."""
    v = _vectors(spark, sf)
    found = batch_top_k(v, _queries(spark, sf), 10, keys=["vec_id"], block_bytes=200 * 8 * DIMS)
    return found.withColumn("similarity", F.round("similarity", 6))


# --- approximate top-k ----------------------------------------------------------------------------

def _indexed(spark, sf, n_cells):
    v = _vectors(spark, sf)
    centroids = cells.train_cells(v, n_cells)
    path = shared_path(spark, "cells")
    cells.write_cells(cells.assign_cells(v, centroids), path, keys=["vec_id"])
    return spark.read.parquet(path), centroids


@query()
def topk_cells(spark, sf):
    """Ten nearest of every vector among the 8 of 32 cells its query probes."""
    indexed, centroids = _indexed(spark, sf, 32)
    found = cells.approx_batch_top_k(indexed, centroids, _queries(spark, sf), 10, nprobe=8, keys=["vec_id"])
    return found.withColumn("similarity", F.round("similarity", 6))


@query(_BATCH)
def topk_cells_full(spark, sf):
    """Probing every cell is exact."""
    indexed, centroids = _indexed(spark, sf, 16)
    found = cells.approx_batch_top_k(indexed, centroids, _queries(spark, sf), 10, nprobe=16, keys=["vec_id"])
    return found.withColumn("similarity", F.round("similarity", 6))


# --- embedding and search -------------------------------------------------------------------------

def hashed_sql(source: str, keys: str, text: str, name: str) -> str:
    """CTEs with the hashing provider's vectors, one row per non-zero component."""
    return rf"""{name}_words AS (SELECT {keys}, unnest(string_split_regex(trim(lower({text})), '\s+')) AS w FROM {source}),
{name}_digests AS (SELECT {keys}, md5(w) AS m FROM {name}_words WHERE w <> ''),
{name}_sums AS (
  SELECT {keys}, CAST('0x' || substr(m, 1, 8) AS BIGINT) % {DIMS} AS slot,
         sum(CASE WHEN CAST('0x' || substr(m, 9, 1) AS INTEGER) < 8 THEN 1.0::DOUBLE ELSE -1.0 END) AS x
  FROM {name}_digests GROUP BY {keys}, slot),
{name} AS (
  SELECT {keys}, slot, CAST(CAST(x / sqrt(sum(x * x) OVER (PARTITION BY {keys})) AS FLOAT) AS DOUBLE) AS x
  FROM {name}_sums WHERE x <> 0)"""


def _embedded(spark, sf):
    return embed(chunks(spark, sf), "chunk_text", dims=DIMS)


@query(f"""
WITH {DOCS}, {CHUNKS}, {hashed_sql('chunks', 'document_id, chunk_index', 'chunk_text', 'v')}
SELECT document_id, chunk_index, CAST(slot AS INTEGER) AS slot, round(x, 6) AS x FROM v""")
def embed_hashing(spark, sf):
    """Vectors of all chunks, as their non-zero components."""
    e = _embedded(spark, sf)
    return (e.select("document_id", "chunk_index", F.posexplode("embedding").alias("slot", "x")).where("x <> 0")
            .withColumn("x", F.round(F.col("x").cast("double"), 6)))


@query(f"""
WITH {DOCS}, {CHUNKS}, {hashed_sql('chunks', 'document_id, chunk_index', 'chunk_text', 'v')},
{hashed_sql('benchmark', 'item_id', 'text', 'b')},
norms AS (SELECT document_id, chunk_index, sqrt(sum(x * x)) AS n FROM v GROUP BY ALL),
query_norms AS (SELECT item_id, sqrt(sum(x * x)) AS n FROM b GROUP BY ALL),
dots AS (SELECT item_id, document_id, chunk_index, sum(b.x * v.x) AS dot FROM b JOIN v USING (slot) GROUP BY ALL),
every AS (SELECT item_id, document_id, chunk_index, qn.n AS qn, c.n AS cn FROM query_norms qn, norms c),
scored AS (SELECT item_id AS query_id, document_id, chunk_index, coalesce(dot, 0) / (qn * cn) AS s
           FROM every LEFT JOIN dots USING (item_id, document_id, chunk_index)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, document_id, chunk_index) AS INTEGER) AS rank
           FROM scored)
SELECT r.query_id, r.rank, r.document_id, d.title, d.doc_type, d.meeting_date, d.url, CAST(r.chunk_index AS BIGINT) AS chunk_index,
       round(r.s, 6) AS similarity
FROM ranked r JOIN docs d USING (document_id) WHERE rank <= 5""")
def search_texts(spark, sf):
    """Every benchmark text searched in the chunks of all documents."""
    wanted = embed(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"), "text", dims=DIMS)
    found = reports.search_many(docs(spark, sf), _embedded(spark, sf), wanted.select("query_id", "embedding"), 5)
    return found.select("query_id", "rank", "document_id", "title", "doc_type", "meeting_date", "url", "chunk_index",
                        F.round("similarity", 6).alias("similarity"))


def _search_sql(facet: str = "") -> str:
    return f"""
WITH {DOCS}, {_QUERY},
scored AS (SELECT d.*, {_SIM.format(a='e.embedding', b='query')} AS s
           FROM embeddings e JOIN docs d ON e.vec_id = d.document_id, q {facet})
SELECT CAST(row_number() OVER (ORDER BY round(s, 9) DESC NULLS LAST, document_id) AS INTEGER) AS rank, document_id AS doc_id,
       title, doc_type, meeting_date, url, CAST(0 AS INTEGER) AS chunk_index, text AS chunk_text, round(s, 6) AS similarity,
       left(text, 300) AS preview
FROM scored QUALIFY rank <= 5"""


def _vector_chunks(spark, sf):
    """The given vectors taken as chunks: vector i is the only chunk of document i."""
    d = docs(spark, sf).select("document_id", F.col("text").alias("chunk_text"))
    v = _vectors(spark, sf).select(F.col("vec_id").alias("document_id"), F.lit(0).alias("chunk_index"), "embedding")
    return v.join(d, "document_id")


@query(_search_sql())
def search(spark, sf):
    found = reports.search(docs(spark, sf), _vector_chunks(spark, sf), _query_vector(spark, sf))
    return found.withColumn("similarity", F.round("similarity", 6))


@query(_search_sql("WHERE d.doc_type = 'fr'"))
def search_facet(spark, sf):
    found = reports.search(docs(spark, sf), _vector_chunks(spark, sf), _query_vector(spark, sf), doc_type="fr")
    return found.withColumn("similarity", F.round("similarity", 6))
