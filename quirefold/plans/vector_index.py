"""An inverted file beside a store, kept up with its commits.

Chunk vectors are stored by cell, the nearest of a set of centroids. The centroids are a versioned artefact, fitted on a
bounded sample; every row is indexed. New batches are added after their commit, and until then searched whole. A cell
that has grown too large is split, and rows of the cells around it that lie nearer to one of its parts go there. A search
takes so many cells, or as many of the nearest as hold a share of all rows. Batches, deletes and compactions of the store hold for the index at once, since its
rows carry the batch they belong to. Changes to the index are numbered commits of its own: a change that another one has
come before is worked out anew.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold import schemas
from quirefold.functions.vectors import unit_rows
from quirefold.operators.cells import NO_CELL, assign_cells, probed_cells, train_cells, within_share, write_cells
from quirefold.operators.select import of_types
from quirefold.sources.commit_log import CommitLog
from quirefold.sources.store import DocumentStore

#: Vectors that centroids are fitted on at most, and vectors of one cell that its parts are fitted on.
FIT_ROWS, SPLIT_ROWS = 100_000, 5_000
#: Cells around one that is split whose rows are looked at again.
NEIGHBOURS = 8
_SHARES = 1 << 20


@dataclass
class IndexState:
    version: int
    generation: str
    cells: np.ndarray
    centroids: np.ndarray
    batches: set[str]
    sizes: np.ndarray  # rows written to each cell, those that deletes have taken since included


def _parts(vectors: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of up to k parts of some unit vectors."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], centroids)
    return np.unique(centroids, axis=0)


class VectorIndex:
    """The inverted file of a store."""

    def __init__(self, store: DocumentStore):
        self.store, self.spark = store, store.spark
        self.root = store.path("index")
        self.log = CommitLog(store.spark, f"{self.root}/log", schemas.INDEX)

    def exists(self) -> bool:
        return self.log.exists() and self.log.version() > 0

    def state(self) -> IndexState | None:
        if not self.exists():
            return None
        changes = sorted(self.log.rows().collect(), key=lambda r: r["version"])  # one row per change
        last = changes[-1]
        # As many rows as cells.
        rows = sorted(self.spark.read.schema(schemas.CENTROIDS).parquet(f"{self.root}/{last['centroids']}").collect(), key=lambda r: r["cell"])
        written: dict[int, int] = {}
        for change in changes:
            if change["generation"] == last["generation"]:
                for r in change["sizes"] or ():
                    written[r["cell"]] = written.get(r["cell"], 0) + r["n"]
        return IndexState(last["version"], last["generation"], np.array([r["cell"] for r in rows], dtype=np.int64),
                          np.array([r["centroid"] for r in rows], dtype=np.float64).reshape(len(rows), -1 if rows else 1),
                          {b for r in changes if r["generation"] == last["generation"] for b in r["batches"]},
                          np.array([written.get(r["cell"], 0) for r in rows], dtype=np.int64))

    def build(self, n_cells: int, fit_rows: int = FIT_ROWS, seed: int = 1) -> None:
        """Fit centroids on a sample of so many of the visible vectors and index all of them, in place of an older index."""
        self.log.bootstrap()
        vectors = self.store.chunks().select(*schemas.CHUNK_KEY, "embedding")
        total = vectors.count()
        share = min(_SHARES, -(-fit_rows * _SHARES // max(1, total)))
        sample = vectors.where(F.pmod(F.xxhash64(*schemas.CHUNK_KEY), F.lit(_SHARES)) < share)
        centroids = train_cells(sample, n_cells, seed=seed) if total else np.zeros((0, 1))
        generation = uuid.uuid4().hex
        name = self._write_centroids(generation, np.arange(len(centroids)), centroids)
        while True:
            version, live = self.log.version(), self.store.live_batches()
            entry, sizes = self._write_rows(generation, self._chunks_of(live), np.arange(len(centroids)), centroids)
            if self._create(version + 1, entry, generation, name, live, sizes):
                return

    def add(self) -> int:
        """Index the batches that have been committed since; how many they are."""
        while True:
            state = self.state()
            if state is None:
                return 0
            missing = [b for b in self.store.live_batches() if b not in state.batches]
            if not missing:
                return 0
            entry, sizes = self._write_rows(state.generation, self._chunks_of(missing), state.cells, state.centroids)
            if self._create(state.version + 1, entry, state.generation, self._centroids_name(state), missing, sizes):
                return len(missing)

    def split(self, max_rows: int) -> int:
        """Split the cells with more rows than that, each by k-means over a sample of its own; how many were split.

        Their rows and those of the nearest ``NEIGHBOURS`` cells around each go to the nearest of all cells again. The
        neighbours keep their centroids under new numbers; cells under old numbers are not read any more.
        """
        while True:
            state = self.state()
            if state is None:
                return 0
            rows = self._rows(state)
            sizes = {r["cell"]: r["n"] for r in rows.where(F.col("cell") != NO_CELL).groupBy("cell").agg(F.count("*").alias("n"))
                     .where(F.col("n") > max_rows).collect()}  # at most one row per cell
            if not sizes:
                return 0
            share = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, min(_SHARES, -(-SPLIT_ROWS * _SHARES // n)))])
            into = {c: -(-2 * n // max_rows) for c, n in sizes.items()}
            overfull = rows.where(F.col("cell").isin(list(sizes)))
            sample = overfull.where(F.pmod(F.xxhash64(*schemas.CHUNK_KEY), F.lit(_SHARES)) < F.try_element_at(share, F.col("cell")))

            def parts(frame: pd.DataFrame) -> pd.DataFrame:
                cell = int(frame["cell"].iloc[0])
                units = unit_rows(np.array(frame.sort_values(list(schemas.CHUNK_KEY))["embedding"].tolist(), dtype=np.float64))
                return pd.DataFrame({"cell": cell, "centroid": _parts(units, into[cell], cell).tolist()})

            found = sample.select(*schemas.CHUNK_KEY, "cell", "embedding").groupBy("cell").applyInPandas(parts, schemas.CENTROIDS).collect()
            split = np.isin(state.cells, list(sizes))
            around = np.argsort(-(state.centroids[split] @ state.centroids.T), axis=1, kind="stable")[:, : NEIGHBOURS + 1]
            moved = np.union1d(np.flatnonzero(split), around)
            kept = np.setdiff1d(np.arange(len(state.cells)), moved)
            fresh = np.concatenate([np.array([c for _, c in sorted((r["cell"], tuple(r["centroid"])) for r in found)]),
                                    state.centroids[moved[~split[moved]]]])
            first = self._next_cell(state)
            cells = np.concatenate([state.cells[kept], np.arange(first, first + len(fresh))])
            centroids = np.concatenate([state.centroids[kept], fresh])
            name = self._write_centroids(state.generation, cells, centroids)
            again = rows.where(F.col("cell").isin([int(c) for c in state.cells[moved]]))
            entry, written = self._write_rows(state.generation, again, cells, centroids)
            if self._create(state.version + 1, entry, state.generation, name, [], written):
                return len(sizes)

    def candidates(self, query, nprobe: int | None = None, doc_type: str | None = None, share: float | None = None) -> DataFrame:
        """Chunk keys and vectors of the cells nearest to a query, and of all batches that are not indexed yet.

        ``nprobe`` says how many cells, or ``share`` what part of all rows they hold at most. Asking for every cell, or
        a share of one, gives every chunk. Cells are partitions, so the others are not read.
        """
        if (nprobe is None) == (share is None):
            raise ValueError("either nprobe or share")
        state = self.state()
        chunks = self.store.chunks()
        if doc_type is not None:
            chunks = of_types(chunks, [doc_type])
        if state is None:
            return chunks.select(*schemas.CHUNK_KEY, "embedding")
        rows = self._rows(state)
        if len(state.cells) and (nprobe < len(state.cells) if share is None else share < 1):
            vector = np.asarray(query, dtype=np.float64)
            near = (probed_cells(vector, state.centroids, nprobe) if share is None
                    else within_share(vector, state.centroids, state.sizes, share))
            rows = rows.where(F.col("cell").isin([int(c) for c in state.cells[near]]))
        if doc_type is not None:
            rows = of_types(rows, [doc_type])
        missing = [b for b in self.store.live_batches() if b not in state.batches]
        found = rows.select(*schemas.CHUNK_KEY, "embedding")
        if missing:
            found = found.unionByName(chunks.where(F.col("ingest_batch").isin(missing)).select(*schemas.CHUNK_KEY, "embedding"))
        return found

    # --- files

    def _path(self, generation: str) -> str:
        return f"{self.root}/{generation}/rows"

    def _rows(self, state: IndexState) -> DataFrame:
        """Rows of the present cells whose entry is committed and whose chunk is visible."""
        entries = self.log.rows().where(F.col("generation") == state.generation).select("entry")
        cells = [int(c) for c in state.cells] + [NO_CELL]
        return (self.spark.read.schema(schemas.INDEX_ROWS).parquet(self._path(state.generation)).where(F.col("cell").isin(cells))
                .join(F.broadcast(entries), "entry", "left_semi")  # one row per change
                .join(self.store.commits().select("ingest_batch"), "ingest_batch", "left_semi")
                .join(self.store.deletes(), ["document_id", "ingest_batch"], "left_anti"))

    def _chunks_of(self, batches: list[str]) -> DataFrame:
        return self.store.rows("chunks").where(F.col("ingest_batch").isin(batches))

    def _write_rows(self, generation: str, chunks: DataFrame, cells: np.ndarray, centroids: np.ndarray) -> tuple[str, dict[int, int]]:
        """The entry that the rows are written under, and their number by cell."""
        entry = uuid.uuid4().hex
        rows = chunks.select(*schemas.CHUNK_KEY, "doc_type", "ingest_batch", "embedding").withColumn("entry", F.lit(entry))
        sizes = write_cells(assign_cells(rows, centroids, cells=cells), self._path(generation), schemas.CHUNK_KEY, mode="append")
        return entry, sizes

    def _write_centroids(self, generation: str, cells: np.ndarray, centroids: np.ndarray) -> str:
        name = f"{generation}/centroids-{uuid.uuid4().hex}"
        rows = [(int(c), v.tolist()) for c, v in zip(cells, centroids)]
        self.spark.createDataFrame(rows, schemas.CENTROIDS).coalesce(1).write.parquet(f"{self.root}/{name}")
        return name

    def _centroids_name(self, state: IndexState) -> str:
        return self.log.rows().where(F.col("version") == state.version).first()["centroids"]

    def _next_cell(self, state: IndexState) -> int:
        """A number that no cell of the generation has had."""
        return max(r["next_cell"] for r in self.log.rows().where(F.col("generation") == state.generation).collect())

    def _create(self, version: int, entry: str, generation: str, centroids: str, batches: list[str],
                sizes: dict[int, int]) -> bool:
        top = self.spark.read.schema(schemas.CENTROIDS).parquet(f"{self.root}/{centroids}").agg(F.max("cell")).first()[0]
        return self.log.create(version, {"entry": entry, "generation": generation, "centroids": centroids, "batches": batches,
                                         "next_cell": 0 if top is None else top + 1,
                                         "sizes": [{"cell": c, "n": n} for c, n in sizes.items()]})
