"""Approximate nearest neighbours: an inverted file of k-means cells."""

import functools

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv
from quirefold.functions.vectors import rows_of_length, unit_rows
from quirefold.operators.topk import (QUERY_BLOCK_BYTES, best_per_query, by_similarity, scan_queries, score)

# Rows compared with all centroids at a time.
_TILE = 1024
# Cell of the rows that have no direction (null or zero vector); searched only when all cells are.
NO_CELL = -1


def train_cells(df: DataFrame, n_cells: int, vector_col: str = "embedding", seed: int = 1,
                max_iter: int = 20) -> np.ndarray:
    """Unit centroids (n_cells x dims), trained on every row that has a direction; k-means runs on Spark."""
    directed = df.select(vector_col).where(F.exists(vector_col, lambda x: x != 0))
    features = directed.select(array_to_vector(vector_col).alias("features"))
    model = KMeans(k=n_cells, distanceMeasure="cosine", seed=seed, maxIter=max_iter).fit(features)
    return unit_rows(np.array(model.clusterCenters(), dtype=np.float64))


def assign_cells(df: DataFrame, centroids: np.ndarray, vector_col: str = "embedding", cells: np.ndarray | None = None) -> DataFrame:
    """Add ``cell``, the number of the nearest centroid (of ``cells``, if given). Map-only; a tile of rows at a time."""
    numbers = np.arange(len(centroids)) if cells is None else np.asarray(cells)
    held = df.sparkSession.sparkContext.broadcast((centroids, numbers))

    @F.arrow_udf(T.IntegerType())
    def nearest(vectors: pa.Array) -> pa.Array:
        centroids, numbers = held.value
        found = np.full(len(vectors), NO_CELL, dtype=np.int32)
        rows, matrix = rows_of_length(vectors, centroids.shape[1])
        for s in range(0, len(rows), _TILE) if len(centroids) else ():
            units = unit_rows(matrix[s : s + _TILE])
            directed = ~np.isnan(units[:, 0])
            found[rows[s : s + _TILE][directed]] = numbers[np.argmax(units[directed] @ centroids.T, axis=1)]
        return pa.array(found)

    return df.withColumn("cell", nearest(F.col(vector_col)))


def write_cells(df: DataFrame, path: str, keys=("document_id", "chunk_index"), rows_per_file: int = 1_000_000,
                mode: str = "overwrite") -> dict[int, int]:
    """Store an assigned table by cell, a large cell spread over as many tasks and files as its size asks for; rows by cell."""
    sizes = df.groupBy("cell").agg(F.count("*").alias("n")).collect()  # one row per cell
    parts = F.create_map(*[F.lit(x) for r in sizes for x in (r["cell"], -(-r["n"] // rows_per_file))])
    salt = F.pmod(F.xxhash64(*keys), F.try_element_at(parts, F.col("cell"))) if sizes else F.lit(0)
    (df.withColumn("_salt", salt).repartition("cell", "_salt").drop("_salt")
     .write.mode(mode).partitionBy("cell").parquet(path))
    return {r["cell"]: r["n"] for r in sizes}


def _probed(vectors: np.ndarray, centroids: np.ndarray, nprobe: int) -> np.ndarray:
    """queries x cells, true where a query looks; asking for every cell includes NO_CELL (last column)."""
    n_cells = len(centroids)
    mask = np.zeros((len(vectors), n_cells + 1), dtype=bool)
    if nprobe >= n_cells:
        mask[:] = True
        return mask
    for s in range(0, len(vectors), _TILE):
        nearest = np.argsort(-(unit_rows(vectors[s : s + _TILE]) @ centroids.T), axis=1)[:, :nprobe]
        np.put_along_axis(mask[s : s + _TILE], nearest, True, axis=1)
    return mask


def probed_cells(query: np.ndarray, centroids: np.ndarray, nprobe: int) -> np.ndarray:
    """Places of the centroids nearest to one query."""
    return np.flatnonzero(_probed(query[None, :], centroids, nprobe)[0][: len(centroids)])


def within_share(query: np.ndarray, centroids: np.ndarray, sizes: np.ndarray, share: float) -> np.ndarray:
    """Places of the nearest centroids, in that order, whose cells hold no more than a share of all rows; at least one."""
    order = np.argsort(-(unit_rows(query[None, :]) @ centroids.T)[0], kind="stable")
    held = np.cumsum(sizes[order])
    return order[: max(1, int(np.searchsorted(held, share * sizes.sum(), side="right")))]


def _only(df: DataFrame, mask: np.ndarray) -> DataFrame:
    cells = [int(c) if c < mask.shape[1] - 1 else NO_CELL for c in np.flatnonzero(mask.any(axis=0))]
    return df.where(F.col("cell").isin(cells))


def approx_top_k(indexed: DataFrame, centroids: np.ndarray, query, k: int = fv.TOP_K, nprobe: int = 8,
                 keys=("document_id", "chunk_index"), vector_col: str = "embedding") -> DataFrame:
    """Exact ranking within the ``nprobe`` nearest cells; other cells are pruned as partitions."""
    mask = _probed(np.asarray(query, dtype=np.float64)[None, :], centroids, nprobe)
    return score(_only(indexed, mask), query, vector_col).orderBy(*by_similarity(keys)).limit(k)


def approx_batch_top_k(indexed: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int = fv.TOP_K,
                       nprobe: int = 8, keys=("document_id", "chunk_index"), vector_col: str = "embedding",
                       query_id: str = "query_id", query_vector: str = "embedding",
                       block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """``batch_top_k`` over the cells each query probes; ``nprobe`` = number of cells is exact."""
    probe = functools.partial(_probed, centroids=centroids, nprobe=nprobe) if nprobe < len(centroids) else None
    found = scan_queries(indexed, queries, k, keys, vector_col, query_id, query_vector, probe, _only, block_bytes)
    return best_per_query(found, k, keys)
