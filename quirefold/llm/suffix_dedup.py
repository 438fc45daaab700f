"""Suffix-array dedup by a depth-limited radix sort of all suffixes.

Suffixes are told apart digit by digit, most significant first, and only through the threshold: a group that falls to
one document is dropped at once, and what is still together after the last digit is exactly a repeated window.

The first digit of a suffix is its window's anchor, the sixteen bytes with the smallest hash among those inside the
window. Equal windows have equal anchors, and neighbouring suffixes share one, so they are dealt with as one run. The
second digit is the run's content. A group of one anchor in which all contents are equal is settled with it: the
first document keeps its windows and all later ones repeat them. Only where an anchor comes with several contents, the
first occurrence of each goes on to the last digit, the whole window. No pass looks beyond the threshold, and no
suffix array is built of what lies deeper.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm import recurrence
from quirefold.llm.common import concatenated, in_units, joined, mix

LENGTH = 50
GRAM = 16
#: Text bytes of one unit: a task holds about a hundred bytes of memory for each byte of text.
UNIT_BYTES = 3 << 20
#: Units per bucket of hashes. Lists sent are as many as units times buckets, so both grow with executors' memory.
UNITS_PER_BUCKET = 4
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_STEP = 1 << 17  # suffixes hashed at a time, so that arrays stay in the processor's cache
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)


def _hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and hash of the window at each suffix; suffixes shorter than the window are left out."""
    n = max(0, len(data) - length + 1)
    anchors, windows = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    for at in range(0, n, _STEP):
        size = min(_STEP, n - at)
        level, powers = _BYTES[data[at : at + size + length - 1]], {}
        power = 1
        while power <= length:
            powers[power] = level
            level = joined(level[:-power], level[power:]) if len(level) > power else level[:0]
            power *= 2
        grams = powers[GRAM]
        lowest, span, wanted = grams, 1, length - GRAM + 1
        while span * 2 <= wanted:
            lowest = np.minimum(lowest[:-span], lowest[span:])
            span *= 2
        rest = wanted - span
        anchors[at : at + size] = np.minimum(lowest[:size], lowest[rest : rest + size])
        whole, done = None, 0
        for power in sorted(powers, reverse=True):
            if length & power:
                part = powers[power][done : done + size]
                whole = part if whole is None else joined(whole, part)
                done += power
        windows[at : at + size] = whole
    return mix(anchors), windows


class _Unit:
    """Bytes of one unit's documents, in ascending order of ids (null first) and then texts."""

    def __init__(self, table: pa.Table, length: int):
        rows = sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        self.number = table["unit"][0].as_py()
        self.ids = [r[0] for r in rows]
        self.data, self.starts = concatenated([r[1] for r in rows])
        sizes = np.diff(self.starts)
        # Rows of one id are one rank: a string must start in a document with a smaller id.
        ranks = np.cumsum([0] + [int(a != b) for a, b in zip(self.ids, self.ids[1:])])[: len(rows)].astype(np.int32)
        anchors, windows = _hashes(self.data, length)
        n = len(anchors)
        whole = np.ones(n, dtype=bool)
        for end in self.starts[1:].tolist():  # windows that would leave their document
            whole[max(0, end - length + 1) : end] = False
        self.at = np.flatnonzero(whole).astype(np.int32)
        self.rank = np.repeat(ranks, sizes)[:n][self.at]
        self.anchors, self.windows = anchors[self.at], windows[self.at]


class _Runs:
    """Suffixes of a unit as runs of one anchor in one document, and the runs by their two digits."""

    def __init__(self, unit: _Unit, length: int, bits: int):
        n, longest = len(unit.anchors), length - GRAM + 1
        new = np.ones(n, dtype=bool)
        new[1:] = ((unit.anchors[1:] != unit.anchors[:-1]) | (unit.rank[1:] != unit.rank[:-1])
                   | (unit.at[1:] != unit.at[:-1] + 1))
        # A run in periodic text can be long: it is cut so that its first and last windows hold all its bytes.
        start = np.flatnonzero(new)
        size = np.diff([*start, n])
        parts = -(-size // longest)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = np.repeat(start, parts) + within * longest
        self.size = np.minimum(longest, np.repeat(start + size, parts) - self.start)
        self.rank = unit.rank[self.start]
        anchor = unit.anchors[self.start] >> np.uint64(64 - bits)
        content = joined(joined(unit.windows[self.start], unit.windows[self.start + self.size - 1]), self.size.astype(np.uint64))
        order = np.lexsort((content, anchor))
        anchor, content = anchor[order], content[order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
        self.anchor, self.content = anchor[first], content[first]
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.cumsum(first) - 1
        begins = np.flatnonzero(first)
        self.first_rank = np.minimum.reduceat(self.rank[order], begins) if len(begins) else self.rank

    def settled(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs that repeat a run of an earlier document, and runs that go on to the last digit."""
        before, mixed = answers
        again = before[self.place] | (self.rank > self.first_rank[self.place])
        return again, ~again & mixed[self.place]

    def suffixes(self, chosen: np.ndarray) -> np.ndarray:
        """Numbers of the suffixes in the chosen runs."""
        start, size = self.start[chosen], self.size[chosen]
        return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _unit_function(length: int, n: int, bits: int):
    def first_pass(table: pa.Table) -> pa.Table:
        unit = _Unit(table, length)
        runs = _Runs(unit, length, bits)
        return recurrence.parcels(unit.number, runs.anchor, runs.content, n, bits)

    def last_pass(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit = _Unit(table, length)
        runs = _Runs(unit, length, bits)
        answers = recurrence.received(replies, runs.anchor, n, bits, rows=2)
        found = np.sort(unit.windows[runs.suffixes(runs.settled(answers)[1])])
        distinct = found[np.concatenate(([True], found[1:] != found[:-1]))] if len(found) else found
        return recurrence.parcels(unit.number, distinct, None, n, 64, np.packbits(answers).tobytes())

    def removed(table: pa.Table, replies: pa.Table) -> tuple[_Unit, np.ndarray]:
        unit = _Unit(table, length)
        runs = _Runs(unit, length, bits)
        answers = np.unpackbits(np.frombuffer(recurrence.kept(replies), dtype=np.uint8), count=2 * len(runs.anchor))
        again, left = runs.settled(answers.reshape(2, -1).astype(bool))
        left = runs.suffixes(left)
        found, where, order, begins = recurrence.grouped(unit.windows[left])
        before = recurrence.received(replies, found, n, 64)
        ranks = unit.rank[left]
        first = np.minimum.reduceat(ranks[order], begins) if len(begins) else begins
        edges = np.zeros(len(unit.data) + 1, dtype=np.int32)
        for suffixes in (runs.suffixes(again), left[before[where] | (ranks > first[where])]):
            at = unit.at[suffixes]
            edges[at] += 1
            edges[at + length] -= 1
        return unit, np.cumsum(edges, dtype=np.int32)[:-1] > 0

    def kept_of(unit: _Unit, gone: np.ndarray, s: int, e: int) -> bytes:
        return unit.data[s:e][~gone[s:e]].tobytes()

    def report(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit, gone = removed(table, replies)
        rows = []
        for doc, s, e in zip(unit.ids, unit.starts.tolist(), unit.starts[1:].tolist()):
            own = gone[s:e]
            spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
            rows.append((doc, e - s, int(own.sum()), spans, hashlib.sha256(kept_of(unit, gone, s, e)).hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.Table.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)],
                                    names=[f.split()[0] for f in RESULT.split(", ")])

    def contents(table: pa.Table, replies: pa.Table) -> pa.Table:
        unit, gone = removed(table, replies)
        kept = [kept_of(unit, gone, s, e) for s, e in zip(unit.starts.tolist(), unit.starts[1:].tolist())]
        return pa.table({"doc_id": pa.array(unit.ids, type=pa.int64()), "content": pa.array(kept, type=pa.binary())})
    return first_pass, last_pass, report, contents


def _run(docs: DataFrame, length: int, unit_bytes: int, result: str, schema: str) -> DataFrame:
    if length < 2 * GRAM:
        raise ValueError(f"length is at least {2 * GRAM} bytes")
    text = F.coalesce(F.col("text"), F.lit(""))
    units, n = in_units(docs, [F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text")], unit_bytes)
    buckets = max(1, n // UNITS_PER_BUCKET)
    bits = min(64, (n * unit_bytes).bit_length() + 10)  # few false groups; they cost work, not rightness
    functions = dict(zip(("first", "last", "report", "contents"), _unit_function(length, buckets, bits)))
    groups = recurrence.earlier_or_mixed(units.groupBy("unit").applyInArrow(functions["first"], recurrence.PARCEL))
    asked = units.groupBy("unit").cogroup(groups.groupBy("unit")).applyInArrow(functions["last"], recurrence.PARCEL)
    repeats = recurrence.earlier(asked)
    return units.groupBy("unit").cogroup(repeats.groupBy("unit")).applyInArrow(functions[result], schema)


def report(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Per document: bytes, removed bytes and spans, and the digest of the kept bytes, one row for every input row.

    A null id is smaller than all others; rows that share an id are one document as to who comes first; a null text is
    empty.
    """
    return _run(docs, length, unit_bytes, "report", RESULT)


def deduplicated(docs: DataFrame, length: int = LENGTH, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """``doc_id`` and the kept bytes; cutting inside a character can leave bytes that are not UTF-8."""
    return _run(docs, length, unit_bytes, "contents", "doc_id long, content binary")
