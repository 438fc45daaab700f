"""Exact nearest neighbours by cosine similarity."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv
from quirefold.functions.vectors import SCORE_DECIMALS, rows_of_length, similarity_to, unit_rows
from quirefold.sources.shared import shared_path

# Query vectors held by one task at a time; more queries go through in blocks of this size.
QUERY_BLOCK_BYTES = 32 << 20
# Of a larger query set, the rows that one task holds, as unit vectors, and the queries that it meets them with.
ROW_SHARE_BYTES, QUERY_SHARE = 64 << 20, 1 << 15
# Queries and rows of one product (of the first one fewer rows, to know what is worth a look), pairs scored at once.
_QUERY_TILE, _ROW_TILE, _FIRST_TILE, _PAIRS = 256, 8192, 1024, 1 << 14
_OUT_ROWS = 1 << 16


def by_similarity(keys):
    """Best first, rows without a score last, ties by key."""
    return [F.round("similarity", SCORE_DECIMALS).desc_nulls_last(), *[F.col(k) for k in keys]]


def score(df: DataFrame, query, vector_col: str = "embedding") -> DataFrame:
    return df.withColumn("similarity", similarity_to(F.col(vector_col), query)).drop(vector_col)


def top_k(df: DataFrame, query, k: int = fv.TOP_K, keys=("document_id", "chunk_index"),
          vector_col: str = "embedding") -> DataFrame:
    """The k rows nearest to one query vector, vector dropped.

    Each task keeps its own k rows (TakeOrderedAndProject), so nothing is shuffled but those.
    """
    return score(df, query, vector_col).orderBy(*by_similarity(keys)).limit(k)


def rank(df: DataFrame, keys, by=()) -> DataFrame:
    """1-based rank; over rows already cut to k per group."""
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return df.withColumn("rank", F.row_number().over(window.orderBy(*by_similarity(keys))))


def ranked_top_k(scored: DataFrame, k: int, keys) -> DataFrame:
    """The k best rows of a table with ``similarity``, with their 1-based ``rank``, for any k.

    Rows are sorted in ranges and written down; a range's ranks begin behind the rows of all ranges before it, so
    neither the driver nor a task holds more than one range.
    """
    order = by_similarity(keys)
    n = scored.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # Not coalesced, as the number of ranges is given: the place within a range is the low part of Spark's row number.
    placed = scored.repartitionByRange(int(n), *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("__range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__place"))
    path = shared_path(scored.sparkSession, "ranked")
    placed.write.parquet(path)
    placed = scored.sparkSession.read.parquet(path)
    before, begins = 0, []
    for number, size in sorted((r[0], r[1]) for r in placed.groupBy("__range").count().collect()):  # one row per range
        begins.append((number, before))
        before += size
    offsets = scored.sparkSession.createDataFrame(begins, "__range int, __before long")
    return (placed.join(F.broadcast(offsets), "__range")
            .withColumn("rank", F.col("__before") + F.col("__place") + 1).where(F.col("rank") <= k)
            .drop("__range", "__place", "__before"))


_NO_SCORE = -2.0  # below every cosine


def _units_of(vectors: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors of Arrow lists; NaN where one is null, zero or of another length."""
    present, matrix = rows_of_length(vectors, dims)
    units = np.full((len(vectors), dims), np.nan)
    units[present] = unit_rows(matrix)
    return units


def _first_of_each(groups: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the first k of their group, in the order they come."""
    order = np.argsort(groups, kind="stable")
    starts = np.flatnonzero(np.r_[True, groups[order][1:] != groups[order][:-1]]) if len(order) else order
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return np.sort(order[place < k])


class _Rows:
    """Rows of the table that may be among the k best of a query, ordered by cell and key.

    Equal vectors have equal scores and are ranked by key, so k copies of each are enough; rows without a direction
    have no score and count as copies of each other. A large group of copies therefore costs no query more than k rows.
    """

    def __init__(self, keys: np.ndarray, units: np.ndarray, cells: np.ndarray | None, k: int):
        cells = np.zeros(len(keys), dtype=np.int64) if cells is None else cells
        order = np.lexsort((*keys.T[::-1], cells))
        keys, units, cells = keys[order], units[order], cells[order]
        self.leading = {c: keys[cells == c][:k] for c in np.unique(cells)}
        directed = np.isfinite(units).all(axis=1)
        self.blank = {c: keys[~directed & (cells == c)][:k] for c in np.unique(cells[~directed])}
        keys, units, cells = keys[directed], np.ascontiguousarray(units[directed]), cells[directed]
        if len(units) > k and units.shape[1]:
            _, copy_of = np.unique(units.view(np.dtype((np.void, units.dtype.itemsize * units.shape[1]))).ravel(), return_inverse=True)
            kept = _first_of_each(copy_of.ravel() + len(units) * np.searchsorted(np.unique(cells), cells), k)
            keys, units, cells = keys[kept], units[kept], cells[kept]
        self.keys, self.units, self.narrow = keys, units, units.astype(np.float32)
        numbers, starts = np.unique(cells, return_index=True)
        self.spans = list(zip(numbers, starts, np.r_[starts[1:], len(cells)]))


class _Best:
    """The k best (score, key) rows of each query seen by one task."""

    def __init__(self, n_queries: int, k: int, n_keys: int):
        self.k = k
        self.scores = np.full((n_queries, k), -np.inf)
        self.keys = np.zeros((n_queries, k, n_keys), dtype=np.int64)
        self.floor = np.full(n_queries, -np.inf)

    def offer(self, queries: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """One (query, score, key) of each row. Ranking is by rounded score, then key."""
        if not len(queries):
            return
        touched = np.unique(queries)
        held, slot = np.nonzero(np.isfinite(self.scores[touched]))
        held = touched[held]
        s = np.concatenate([self.scores[held, slot], scores])
        ks = np.concatenate([self.keys[held, slot], keys])
        q = np.concatenate([held, queries])
        order = np.lexsort((*ks.T[::-1], -np.round(s, SCORE_DECIMALS), q))
        s, ks, q = s[order], ks[order], q[order]
        starts = np.searchsorted(q, touched)
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        kept = place < self.k
        self.scores[touched] = -np.inf
        self.scores[q[kept], place[kept]] = s[kept]
        self.keys[q[kept], place[kept]] = ks[kept]
        self.floor[touched] = np.round(self.scores[touched, -1], SCORE_DECIMALS)

    def batches(self, query_ids: np.ndarray):
        """What was found, as Arrow batches of a bounded number of queries."""
        step = max(1, _OUT_ROWS // self.k)
        for at in range(0, len(query_ids), step):
            q, slot = np.nonzero(np.isfinite(self.scores[at:at + step]))
            if len(q):
                found, keys = self.scores[at:at + step][q, slot], self.keys[at:at + step][q, slot]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[at:at + step][q]), *[pa.array(keys[:, i]) for i in range(keys.shape[1])],
                     pa.array(np.where(found == _NO_SCORE, np.nan, found), from_pandas=True)],
                    names=["query_id", *[f"key{i}" for i in range(keys.shape[1])], "similarity"])


def _compare(best: _Best, units: np.ndarray, rows: _Rows, probes: np.ndarray | None) -> None:
    """Offer the rows to every query, a tile of queries and a tile of rows at a time.

    Single-precision products only tell which pairs cannot be among the best, by a bound on their error; the others are
    scored in double precision.
    """
    k, dims = best.k, units.shape[1]
    slack = 4 * (dims + 8) * 2.0 ** -24 + 2 * 10.0 ** -SCORE_DECIMALS
    directed = np.isfinite(units).all(axis=1)
    for first in range(0, len(units), _QUERY_TILE):
        tile = np.arange(first, min(first + _QUERY_TILE, len(units)))
        some = tile[directed[tile]]
        for cell, start, end in rows.spans:
            asking = some if probes is None else some[probes[some, cell]]
            narrow, at, width = units[asking].astype(np.float32), start, _FIRST_TILE
            while at < end and len(asking):
                stop = min(end, at + width)
                near = narrow @ rows.narrow[at:stop].T
                least = best.floor[asking] - slack
                fit = near >= least[:, None]
                if stop - at > k and np.count_nonzero(fit) > 4 * k * len(asking):
                    least = np.maximum(least, np.partition(near, stop - at - k, axis=1)[:, stop - at - k] - slack)
                    fit = near >= least[:, None]
                q, r = np.nonzero(fit)
                for s in range(0, len(q), _PAIRS):
                    qs, rs = asking[q[s:s + _PAIRS]], at + r[s:s + _PAIRS]
                    best.offer(qs, np.einsum("ij,ij->i", units[qs], rows.units[rs]), rows.keys[rs])
                at, width = stop, _ROW_TILE
        for cells, asking in ((rows.blank, some[best.floor[some] <= _NO_SCORE]), (rows.leading, tile[~directed[tile]])):
            for cell, keys in cells.items():
                now = asking if probes is None else asking[probes[asking, cell]]
                best.offer(np.repeat(now, len(keys)), np.full(len(now) * len(keys), _NO_SCORE), np.tile(keys, (len(now), 1)))


def _numbers(batch, names) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype(np.int64)


def _scan_rows(batches, query_ids, units, probes, k, key_names):
    """Arrow batches of rows in, the k best per query of the queries held out."""
    best = _Best(len(units), k, len(key_names))
    for batch in batches:
        if batch.num_rows:
            cells = None if probes is None else batch.column("cell").to_numpy(zero_copy_only=False)
            _compare(best, units, _Rows(_numbers(batch, key_names), _units_of(batch.column("vector"), units.shape[1]), cells, k), probes)
    yield from best.batches(query_ids)


def _scan_parts(batches, dims, per_block, probe, k, key_names):
    """Arrow batches of one part, its rows first, then queries: the k best of the part's rows for each query.

    The rows are held; of the queries, one block at a time.
    """
    held, rows = [], None
    for batch in batches:
        asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        n_rows = int(np.searchsorted(asks, True))
        if n_rows:
            part = batch.slice(0, n_rows)
            held.append((_numbers(part, key_names), _units_of(part.column("vector"), dims),
                         None if probe is None else part.column("cell").to_numpy(zero_copy_only=False)))
        if n_rows < batch.num_rows and rows is None:
            if not held:
                return
            keys, units, cells = zip(*held)
            held = []
            rows = _Rows(np.concatenate(keys), np.concatenate(units), None if probe is None else np.concatenate(cells), k)
            del keys, units, cells
        for at in range(n_rows, batch.num_rows, per_block):
            block = batch.slice(at, per_block)
            units = _asked(block.column("vector"), dims)
            best = _Best(len(units), k, len(key_names))
            _compare(best, units, rows, None if probe is None else probe(units))
            yield from best.batches(block.column("query_id").to_numpy(zero_copy_only=False))


def _asked(vectors: pa.Array, dims: int) -> np.ndarray:
    present, matrix = rows_of_length(vectors, dims)
    if len(present) < len(vectors):
        raise ValueError("query vectors differ in length")
    return unit_rows(matrix)


def _found_type(n_keys: int) -> T.StructType:
    return T.StructType([T.StructField("query_id", T.LongType()), *[T.StructField(f"key{i}", T.LongType()) for i in range(n_keys)],
                         T.StructField("similarity", T.DoubleType())])


def _held_by_tasks(table: DataFrame, queries: DataFrame, dims: int, k: int, key_names, probe, only) -> DataFrame:
    """Every task holds all query vectors and reads its own rows of the table."""
    asked = queries.toArrow().combine_chunks()  # one block at most
    units = _asked(asked.column("vector").combine_chunks(), dims)
    probes = None if probe is None else probe(units)
    held = table.sparkSession.sparkContext.broadcast((asked.column("query_id").to_numpy(), units, probes))

    def scan(batches):
        query_ids, query_units, query_probes = held.value
        return _scan_rows(batches, query_ids, query_units, query_probes, k, key_names)

    return (table if probes is None else only(table, probes)).mapInArrow(scan, _found_type(len(key_names)))


def _in_parts(table: DataFrame, queries: DataFrame, n: int, dims: int, k: int, key_names, probe, per_block: int) -> DataFrame:
    """Rows and queries dealt over the fields of a grid: each task meets one share of the rows with one of the queries.

    The table is written down, so that whatever made its vectors runs once, and shares are of even size.
    """
    spark = table.sparkSession
    path = shared_path(spark, "table")
    table.write.parquet(path)
    table = spark.read.parquet(path)
    n_rows = max(1, math.ceil(table.count() * 8 * dims / ROW_SHARE_BYTES))
    n_queries = max(math.ceil(n / QUERY_SHARE), math.ceil(2 * spark.sparkContext.defaultParallelism / n_rows))

    def dealt(df, own, other, part):
        # The place of a row in its files, which is the same whenever they are read.
        df = df.withColumn("own", F.pmod(F.monotonically_increasing_id(), F.lit(own)).cast("int"))
        return df.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).withColumn("part", part).drop("own", "other")

    wide = table.schema["vector"].dataType == queries.schema["vector"].dataType
    rows, asked = (df if wide else df.withColumn("vector", F.col("vector").cast("array<double>")) for df in (table, queries))
    rows = dealt(rows, n_rows, n_queries, F.col("other") * n_rows + F.col("own")).withColumn("asks", F.lit(False))
    asked = dealt(asked, n_queries, n_rows, F.col("own") * n_rows + F.col("other")).withColumn("asks", F.lit(True))
    parts = (rows.unionByName(asked, allowMissingColumns=True).repartitionById(n_rows * n_queries, F.col("part"))
             .sortWithinPartitions("asks").drop("part"))
    held = spark.sparkContext.broadcast(probe)
    return parts.mapInArrow(lambda batches: _scan_parts(batches, dims, per_block, held.value, k, key_names), _found_type(len(key_names)))


def scan_queries(df: DataFrame, queries: DataFrame, k: int, keys, vector_col: str, query_id: str, query_vector: str,
                 probe=None, only=None, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """Per-task candidates of every query, for ``batch_top_k`` and the cell index.

    The query vectors are written down first, as a provider may have made them and is not to be called again, and
    counted. A query without a vector has no neighbours. A set that fits one block is held by every task, and the table
    stays where it is. A larger one meets the table on a grid, in one job: a task holds a bounded share of the rows and
    one block of queries at a time, and the driver none. ``probe`` gives the cells (queries x cells) that unit vectors
    ask for, and ``only`` the rows of a table that lie in any of them.
    """
    asked = shared_path(df.sparkSession, "queries")
    (queries.where(F.col(query_vector).isNotNull()).select(F.col(query_id).cast("bigint").alias("query_id"), F.col(query_vector).alias("vector"))
     .write.parquet(asked))
    queries = df.sparkSession.read.parquet(asked)
    size = queries.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dims")).first()
    n, dims, key_names = size["n"], max(0, size["dims"]), [f"key{i}" for i in range(len(keys))]
    # What a block holds of a query: its vector, and its k best rows.
    per_block = max(1, min(block_bytes // (8 * max(1, dims)), QUERY_BLOCK_BYTES // (8 * k * (1 + len(keys)))))
    table = df.select(*[F.col(c).cast("bigint").alias(f"key{i}") for i, c in enumerate(keys)], F.col(vector_col).alias("vector"),
                      *([] if probe is None else [F.col("cell").cast("bigint").alias("cell")]))
    found = (_held_by_tasks(table, queries, dims, k, key_names, probe, only) if n <= per_block else
             _in_parts(table, queries, n, dims, k, key_names, probe, per_block))
    return found.select("query_id", *[F.col(f"key{i}").alias(c) for i, c in enumerate(keys)], "similarity")


def best_per_query(found: DataFrame, k: int, keys) -> DataFrame:
    """Cut the tasks' candidates to k per query, ranked."""
    return rank(found, keys, by=["query_id"]).where(F.col("rank") <= k)


def batch_top_k(df: DataFrame, queries: DataFrame, k: int = fv.TOP_K, keys=("document_id", "chunk_index"),
                vector_col: str = "embedding", query_id: str = "query_id", query_vector: str = "embedding",
                block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """(query_id, keys..., similarity, rank): the k nearest rows of every query vector. Integer keys.

    Pairs are scored as matrix products inside the tasks and only k rows per query leave a task, so pairs never become rows.
    """
    found = scan_queries(df, queries, k, keys, vector_col, query_id, query_vector, block_bytes=block_bytes)
    return best_per_query(found, k, keys)
