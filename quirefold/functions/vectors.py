"""Vector expressions: cosine, literal format, narrowing and truncation."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scores that agree to this many decimals count as ties and are ordered by key.
SCORE_DECIMALS = 9


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 - cosine distance of two vector columns; null when a vector is null, zero or of another length."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(F.size(a) == F.size(b), _dot(a, b) / F.nullif(norms, F.lit(0.0)))


def rows_of_length(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, float64 matrix) of the vectors that are present and have the right length."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    kept = vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows))
    flat = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows, flat.reshape(len(rows), dims)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row becomes NaN."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(divide="ignore", invalid="ignore"):
        return matrix / norms[:, None]


def similarity_to(c: Column, query) -> Column:
    """Cosine similarity of a vector column to one query vector, by Arrow batch."""
    unit = unit_rows(np.asarray(query, dtype=np.float64)[None, :])[0]

    @F.arrow_udf(T.DoubleType())
    def score(vectors: pa.Array) -> pa.Array:
        rows, matrix = rows_of_length(vectors, len(unit))
        scores = np.full(len(vectors), np.nan)
        scores[rows] = np.einsum("ij,j->i", unit_rows(matrix), unit)
        return pa.array(scores, from_pandas=True)

    return score(c)


def to_literal(c: Column) -> Column:
    """'[a,b,...]'"""
    return F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ","), F.lit("]"))


def parse_literal(c: Column) -> Column:
    return F.from_json(c, "array<float>")


def narrow(c: Column) -> Column:
    return c.cast("array<float>")


def truncate_dims(c: Column, dims: int, renormalise: bool = False) -> Column:
    """First ``dims`` components, optionally scaled back to unit length."""
    head = F.slice(c, 1, dims)
    if not renormalise:
        return head
    norm = F.nullif(F.sqrt(_dot(head, head)), F.lit(0.0))
    return F.transform(head, lambda x: (x / norm).cast("float"))
