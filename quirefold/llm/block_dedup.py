"""Substring dedup on words by fixed-block anchors.

Every document is a reference: its non-overlapping blocks of ten words are indexed. All documents probe the index with
every rolling window of ten words. A repeated passage of twenty words holds a whole block of its earlier occurrence,
so it shows up as a hit on both sides; around hits the passages are extended to the maximal repeats, which are the
runs of twenty-word windows that all start earlier as well.
"""

import hashlib
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm import recurrence
from quirefold.llm.common import in_units, run_hashes

LENGTH = 20
#: Text bytes of one unit: a task holds about thirty bytes of memory for each byte of text.
UNIT_BYTES = 6 << 20
#: Units per bucket of hashes. Lists sent are as many as units times buckets, so both grow with executors' memory.
UNITS_PER_BUCKET = 4
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class _Unit:
    """Words of one unit's documents, in ascending order of ids (null first) and then texts."""

    def __init__(self, table: pa.Table, length: int):
        rows = sorted(zip(table["doc_id"].to_pylist(), [t.split() for t in table["text"].to_pylist()]),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        self.number = table["unit"][0].as_py()
        self.docs = [r[0] for r in rows]
        self.words = [w for r in rows for w in r[1]]
        self.starts = np.zeros(len(rows) + 1, dtype=np.int64)
        np.cumsum([len(r[1]) for r in rows], out=self.starts[1:])
        self.block = length // 2
        hashed = pd.util.hash_array(np.array(self.words, dtype=object), categorize=False) if self.words else np.zeros(
            0, dtype=np.uint64)
        runs = run_hashes(hashed, [self.block, length])
        sizes = np.diff(self.starts)
        self.left = np.repeat(self.starts[1:], sizes) - np.arange(len(self.words))  # words to the document's end
        self.offset = np.arange(len(self.words)) - np.repeat(self.starts[:-1], sizes)
        self.probes = np.flatnonzero(self.left >= self.block)
        self.probe_hashes = runs[self.block][self.probes]
        self.windows = np.flatnonzero(self.left >= length)
        self.window_hashes = runs[length]


def _flags(distinct, place, counts, indexed):
    flags = np.where(counts > 1, recurrence.REPEATED, 0).astype(np.uint8)
    flags[place[indexed]] |= recurrence.INDEXED
    return flags


def _hits(unit: _Unit, bits: int):
    short = unit.probe_hashes >> np.uint64(64 - bits)
    distinct, place, _, begins = recurrence.grouped(short)
    indexed = unit.offset[unit.probes] % unit.block == 0
    return distinct, place, _flags(distinct, place, np.diff([*begins, len(short)]), indexed)


def _around_hits(unit: _Unit, hit: np.ndarray, length: int) -> np.ndarray:
    """Windows of the full length that hold a hit block."""
    at = np.zeros(len(unit.words) + 1, dtype=np.int64)
    at[unit.probes[hit] + 1] = 1
    at = np.cumsum(at)
    first = unit.windows
    return first[at[first + length - unit.block + 1] > at[first]]


def _unit_function(length: int, n: int, bits: int):
    def ask_index(table: pa.Table) -> pa.Table:
        unit = _Unit(table, length)
        distinct, _, flags = _hits(unit, bits)
        return recurrence.parcels(unit.number, distinct, flags, n, bits)

    def ask_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit = _Unit(table, length)
        distinct, place, _ = _hits(unit, bits)
        hit = recurrence.received(replies, distinct, n, bits)
        windows = _around_hits(unit, hit[place], length)
        return recurrence.parcels(unit.number, recurrence.grouped(unit.window_hashes[windows])[0], None, n, 64,
                                  np.packbits(hit).tobytes())

    def removed(table: pa.Table, replies: pa.Table) -> tuple[_Unit, np.ndarray]:
        unit = _Unit(table, length)
        distinct, place, _ = _hits(unit, bits)
        hit = np.unpackbits(np.frombuffer(recurrence.kept(replies), dtype=np.uint8), count=len(distinct)).astype(bool)
        windows = _around_hits(unit, hit[place], length)
        found, where, order, begins = recurrence.grouped(unit.window_hashes[windows])
        before = recurrence.received(replies, found, n, 64)
        first = np.minimum.reduceat(windows[order], begins) if len(begins) else begins
        again = windows[before[where] | (windows > first[where])]
        edges = np.zeros(len(unit.words) + 1, dtype=np.int32)
        edges[again] += 1
        edges[again + length] -= 1
        return unit, np.cumsum(edges)[:-1] > 0

    def report(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit, gone = removed(table, replies)
        rows = []
        for doc, s, e in zip(unit.docs, unit.starts.tolist(), unit.starts[1:].tolist()):
            n_gone = int(gone[s:e].sum())
            kept = unit.words[s:e] if not n_gone else compress(unit.words[s:e], ~gone[s:e])
            rows.append((doc, e - s, n_gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(
            zip(*rows), [pa.int64(), pa.int64(), pa.int64(), pa.string()])], names=[f.split()[0] for f in RESULT.split(", ")])

    def texts(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit, gone = removed(table, replies)
        kept = [b" ".join(compress(unit.words[s:e], ~gone[s:e])).decode()
                for s, e in zip(unit.starts.tolist(), unit.starts[1:].tolist())]
        return pa.table({"doc_id": pa.array(unit.docs, type=pa.int64()), "text": pa.array(kept, type=pa.string())})
    return ask_index, ask_windows, report, texts


def _run(docs: DataFrame, length: int, unit_bytes: int, result, schema: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    units, n = in_units(docs, [F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text")], unit_bytes)
    buckets = max(1, n // UNITS_PER_BUCKET)
    bits = min(64, (n * unit_bytes).bit_length() + 10)  # few false hits; they cost work, not rightness
    functions = dict(zip(("index", "windows", "report", "texts"), _unit_function(length, buckets, bits)))
    asked = units.groupBy("unit").applyInArrow(functions["index"], recurrence.PARCEL)
    hits = recurrence.recurring(asked)
    asked = units.groupBy("unit").cogroup(hits.groupBy("unit")).applyInArrow(functions["windows"], recurrence.PARCEL)
    repeats = recurrence.earlier(asked)
    return units.groupBy("unit").cogroup(repeats.groupBy("unit")).applyInArrow(functions[result], schema)


def report(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Per document: words, removed words and the digest of the kept ones, one row for every input row.

    Rows that share an id count as documents that follow each other in the order of their texts; null ids come first;
    a null text has no words.
    """
    return _run(docs, length, unit_bytes, "report", RESULT)


def deduplicated(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """``doc_id`` and the text of the kept words, joined by single spaces."""
    return _run(docs, length, unit_bytes, "texts", "doc_id long, text string")
