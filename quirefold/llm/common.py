"""What several operators share: laying documents out in ranges of their ids, hashes of runs, packed integers."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.sources.shared import shared_root

#: Text bytes of one unit of work, small enough to lie in a Python worker several times over.
UNIT_BYTES = 8 << 20

#: Text bytes that count once when ranges of ids are weighed.
GRAIN = 1 << 10

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame with its rows in the shared checkpoint folder and its lineage cut."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


@dataclass
class Carried:
    """Rows whose columns travel as one struct, so that no name of theirs meets a name of the operator's own.

    ``rows`` has the struct as ``row`` and the wanted columns under their names.
    """

    rows: DataFrame
    names: list[str]

    def back(self, frame: DataFrame, **changed) -> DataFrame:
        """The columns that were carried, under their names and in their order; some with another value."""
        return frame.select(*[changed.get(n, F.col(f"row.c{i}")).alias(n) for i, n in enumerate(self.names)],
                            *[c.alias(n) for n, c in changed.items() if n not in self.names])


def carried(docs: DataFrame, *wanted: str) -> Carried:
    """All columns of ``docs``, whatever their names: dots, names that differ in case only, names operators use."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    row = F.struct(*plain.columns).alias("row")
    return Carried(plain.select(row, *[F.col(f"c{docs.columns.index(w)}").alias(w) for w in wanted]), docs.columns)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def id_cuts(docs: DataFrame, n: int, key: str = "doc_id", text: str | None = None) -> list[int]:
    """First ids of about ``n`` ranges that hold as many rows each, or as many bytes of a text; one number per range."""
    if n <= 1:
        return []
    steps = [i / n for i in range(1, n)]
    if text is not None:  # an id counts once for every grain of its text, rounded up or down at random by what is left
        grains = F.floor(F.coalesce(F.octet_length(text), F.lit(0)) / GRAIN + F.rand(0)).cast("int")
        docs = docs.select(key, grains.alias("grains")).where("grains > 0").select(key, F.explode(F.sequence(F.lit(1), F.col("grains"))))
    found = docs.agg(F.percentile_approx(key, steps, max(10_000, 20 * n))).first()[0]
    return sorted(set(found or []))


def range_of(key: str, cuts: list[int]):
    """Number of the range that an id lies in; ranges ascend with the ids, null ids lie in range 0."""
    edges = np.asarray(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        values = ids.fillna(0).astype("int64").to_numpy()
        return pd.Series(np.where(known, np.searchsorted(edges, values, side="right"), 0).astype(np.int32))
    return number(F.col(key).cast("long"))


def in_units(docs: DataFrame, columns: list, unit_bytes: int = UNIT_BYTES, key: str = "doc_id") -> tuple[DataFrame, int]:
    """Documents dealt out by ranges of their ids, as column ``unit``, and the number of units.

    Ranges hold about as many bytes of text each, so long documents that follow each other lie in units of their own. Every unit lies whole in one partition, and unit numbers ascend with the ids.
    """
    n = max(1, -(-text_bytes(docs) // unit_bytes))
    cuts = id_cuts(docs, n, key, "text")
    units = docs.select(*columns).withColumn("unit", range_of(key, cuts)) if cuts else (
        docs.select(*columns).withColumn("unit", F.lit(0)))
    return units.repartition(n, "unit"), n


def concatenated(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes after each other, and where each text starts (one more entry for the end)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), starts


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all of them; one to one."""
    x = x ^ (x >> np.uint64(32))
    x *= M2
    x ^= x >> np.uint64(29)
    return x


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each pair, in which order matters."""
    return mix(a * M1 + b)


def run_hashes(values: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all runs of the given lengths in a sequence of 64-bit values, by doubling.

    Entry i of the result for length L stands for ``values[i : i + L]``; runs that would leave the end are absent.
    """
    powers, out, size = {1: values}, {}, 1
    while size * 2 <= max(lengths):
        h = powers[size]
        powers[size * 2] = joined(h[: len(h) - size], h[size:]) if len(h) > size else h[:0]
        size *= 2
    for length in lengths:
        parts, at = None, 0
        for power in sorted(powers, reverse=True):
            if length & power:
                h = powers[power]
                n = max(0, len(values) - length + 1)
                piece = h[at : at + n]
                parts = piece if parts is None else joined(parts[:n], piece)
                at += power
        out[length] = parts[: max(0, len(values) - length + 1)]
    return out


_SQUEEZE = {"compressor": None, "decompressor": None}


def packed(sorted_values: np.ndarray) -> bytes:
    """Ascending integers as compressed byte planes of their differences."""
    if _SQUEEZE["compressor"] is None:
        _SQUEEZE["compressor"] = zstandard.ZstdCompressor(level=1)
    steps = sorted_values.copy()
    steps[1:] -= sorted_values[:-1]
    planes = steps.view(np.uint8).reshape(-1, steps.itemsize).T
    return _SQUEEZE["compressor"].compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, dtype) -> np.ndarray:
    if _SQUEEZE["decompressor"] is None:
        _SQUEEZE["decompressor"] = zstandard.ZstdDecompressor()
    planes = np.frombuffer(_SQUEEZE["decompressor"].decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    steps = np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)
    return np.cumsum(steps, dtype=dtype)

