"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code over the 64 bits: a product of three binary Golay codes, which are perfect,
so every fingerprint lies within the covering radius (three bits per factor) of exactly one anchor, its home. Two
fingerprints with at most three differing bits have a point between them that is one bit from the one and two bits
from the other. So each fingerprint is copied to every anchor within the covering radius plus two bits, the larger
part of the threshold: both then meet at that point's home. Fingerprints are compared within each anchor only.

Only distinct fingerprints are copied, whatever the number of documents that share one. A cell around one centre is
bounded by the code: no more than 43,745 distinct fingerprints lie within three bits of a point.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import carried, checkpointed, mix, packed, unpacked
from quirefold.llm.components import components

SHINGLE, THRESHOLD, SEED = 3, 3, 42
#: Copies in one bucket of anchors.
BUCKET_COPIES = 1 << 20
_SMALL = 48  # groups up to this size are compared in whole columns

# The generator polynomial of the binary Golay code, and how the 64 bits fall to three factors (the
# last one is filled up with zeros).
GENERATOR, LENGTH = 0b110001110101, 23
FACTORS = ((0, 23), (23, 23), (46, 18))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The contract's fingerprint of one text."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    first = [0, *(ends[: n - 1] + 1).tolist()]
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(first, last)])
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = np.frombuffer(hashes, dtype=np.uint8, offset=8 * at, count=8 * min(1 << 16, n - at))
        bits += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, fp`` of every row: mark is a hash of the text, fp holds the 64 bits as a signed number. A null
    text has no words."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t or b"", shingle) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "mark", "fp"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp long")


def _mark() -> Column:
    return F.xxhash64("text").alias("mark")


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


class Covering:
    """Anchors of the code near fingerprints, as tables over the 2,048 syndromes of each factor."""

    def __init__(self, radius: int = THRESHOLD - THRESHOLD // 2):
        """``radius``: bits beyond the covering radius."""
        units = []
        for i in range(LENGTH):
            rest = 1 << i
            for b in range(LENGTH - 1, 10, -1):
                if rest >> b & 1:
                    rest ^= GENERATOR << (b - 11)
            units.append(rest)
        self.units = np.array(units, dtype=np.int64)
        leaders = np.zeros(1 << 11, dtype=np.int64)
        for weight in range(4):
            for chosen in combinations(range(LENGTH), weight):
                leaders[self._xor(units, chosen)] = sum(1 << i for i in chosen)
        self.leaders = leaders
        self.steps = {width: self._steps(width, radius) for _, width in FACTORS}
        self.radius = radius

    @staticmethod
    def _xor(units, chosen) -> int:
        out = 0
        for i in chosen:
            out ^= units[i]
        return out

    def _steps(self, width: int, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per number of flipped bits: for each syndrome, the changes of the home that need so many, padded by -1."""
        states = np.arange(1 << 11)
        seen = [set() for _ in states]
        out = []
        for weight in range(radius + 1):
            lists = [[] for _ in states]
            for chosen in combinations(range(width), weight):
                flips = sum(1 << i for i in chosen)
                change = (flips ^ self.leaders[states ^ self._xor(self.units.tolist(), chosen)] ^ self.leaders) >> 11
                for state, c in enumerate(change.tolist()):
                    if c not in seen[state]:
                        seen[state].add(c)
                        lists[state].append(c)
            table = np.full((len(states), max(map(len, lists))), -1, dtype=np.int64)
            for state, c in enumerate(lists):
                table[state, : len(c)] = c
            out.append(table)
        return out

    def copies(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, index of the fingerprint) for every copy. An anchor's number is 12 message bits per factor."""
        homes, states = [], []
        for at, width in FACTORS:
            part = ((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
            state = np.zeros(len(fps), dtype=np.int64)
            for i in range(width):
                state ^= np.where(part >> i & 1, self.units[i], 0)
            homes.append((part ^ self.leaders[state]) >> 11)
            states.append(state)
        index = np.arange(len(fps))
        anchors, owners = [], []
        shares = [(a, b, c) for a in range(self.radius + 1) for b in range(self.radius + 1 - a)
                  for c in range(self.radius + 1 - a - b)]
        for share in shares:
            number, owner, valid = np.zeros(len(fps), dtype=np.int64), index, np.ones(len(fps), dtype=bool)
            for (_, width), home, state, flips in zip(FACTORS, homes, states, share):
                table = self.steps[width][flips][state[owner]]
                wide = table.shape[1]
                number = ((np.repeat(number, wide) << 12) | (np.repeat(home[owner], wide) ^ np.maximum(table.ravel(), 0)))
                valid = table.ravel() >= 0
                owner = np.repeat(owner, wide)[valid]
                number = number[valid]
            anchors.append(number)
            owners.append(owner)
        return np.concatenate(anchors).astype(np.uint64), np.concatenate(owners)


def _sent(n_buckets: int, radius: int):
    """Copies of a task's fingerprints, a row per bucket of anchors: keys ascending, and the fingerprints with them."""
    edges = np.array([k * ((1 << 64) // n_buckets) for k in range(1, n_buckets)], dtype=np.uint64)

    def run(batches):
        covering = Covering(radius)
        for batch in batches:
            all_fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(all_fps), 4096):
                fps = all_fps[at : at + 4096]
                anchors, owners = covering.copies(fps)
                keys = mix(anchors * np.uint64(0x9E3779B97F4A7C15))  # one to one
                order = np.argsort(keys)
                keys, copied = keys[order], fps[owners[order]]
                cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                rows = [(b, packed(keys[s:e]), copied[s:e].tobytes()) for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(
                    columns, [pa.int32(), pa.binary(), pa.binary()])], names=["bucket", "keys", "fps"])
    return run


def _reached(fps: np.ndarray, threshold: int):
    """Links that join the components of one large anchor. A fingerprint leaves the rest once it is reached, so a
    dense anchor takes few comparisons."""
    rest = np.arange(len(fps))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        frontier, members = np.array([seed]), []
        while len(frontier) and len(rest):
            hit = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(frontier), 256):
                open_ = np.flatnonzero(~hit)
                near = np.zeros(len(open_), dtype=bool)
                for f in frontier[at : at + 256]:
                    near |= np.bitwise_count(fps[rest[open_]] ^ fps[f]) <= threshold
                hit[open_[near]] = True
            frontier, rest = rest[hit], rest[~hit]
            members.append(frontier)
        if members:
            members = np.concatenate(members)
            yield np.full(len(members), fps[seed]), fps[members]


def _compared(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpacked(k, np.uint64) for k in table["keys"].to_pylist()])
        fps = np.concatenate([np.frombuffer(f, dtype=np.uint64) for f in table["fps"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, fps = keys[order], fps[order]
        begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff([*begins, len(keys)])
        left, right = [], []
        for s, n in zip(begins[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
            for a, b in _reached(fps[s : s + n], threshold):
                left.append(a)
                right.append(b)
        small = np.repeat((sizes > 1) & (sizes <= _SMALL), sizes)
        keys, fps = keys[small], fps[small]
        for step in range(1, _SMALL):
            near = (keys[step:] == keys[:-step]) if len(keys) > step else np.zeros(0, dtype=bool)
            if not near.any():
                break
            near &= np.bitwise_count(fps[step:] ^ fps[: len(fps) - step]) <= threshold
            left.append(fps[: len(fps) - step][near])
            right.append(fps[step:][near])
        a = np.concatenate(left) if left else fps[:0]
        b = np.concatenate(right) if right else fps[:0]
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return pa.table({"a": pa.array(a[new].view(np.int64)), "b": pa.array(b[new].view(np.int64))})
    return run


def links(fps: DataFrame, threshold: int = THRESHOLD, bucket_copies: int = BUCKET_COPIES) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``fp`` that join all that are within the threshold."""
    n_buckets = max(1, fps.count() * 120 // bucket_copies)
    radius = threshold - threshold // 2
    sent = fps.select("fp").mapInArrow(_sent(n_buckets, radius), "bucket int, keys binary, fps binary")
    return sent.groupBy("bucket").applyInArrow(_compared(threshold), "a long, b long").distinct()


def classes(rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``fp, root`` for every distinct fingerprint of ``rows``: equal roots for all that links connect."""
    distinct = checkpointed(rows.select("fp").distinct())
    roots = components(links(distinct, threshold))
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; the component is the smallest id that can be reached over
    links of at most so many differing bits. Null ids name no component that holds another id.
    """
    rows = checkpointed(fingerprints(docs, shingle))
    roots = checkpointed(classes(rows, threshold))
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    least = roots.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The documents, all columns, with one left of each component: the smallest id, null last, and of rows that share
    it the smallest text hash. Of rows equal in id and text any one stays."""
    every = carried(docs, "doc_id", "text")
    rows = checkpointed(fingerprints(every.rows, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "mark")).alias("first")
    roots = classes(rows, threshold)
    kept = checkpointed(roots.join(rows.groupBy("fp").agg(first), "fp").groupBy("root").agg(F.min("first").alias("first"))
                        .select(F.col("first.doc_id").alias("kept_id"), F.col("first.mark").alias("kept_mark")))
    marked = every.rows.select("row", "doc_id", F.xxhash64("text").alias("mark"))
    left = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark")), "left_semi")
    repeated = rows.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count()
    if repeated:  # texts are shuffled and sorted only where rows repeat
        left = left.dropDuplicates(["doc_id", "mark"])
    return every.back(left)
