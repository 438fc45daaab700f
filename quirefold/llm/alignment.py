"""Alignment of two tokenizers over a corpus: which ids of one share bytes with which ids of the other, and how often.

Both tokenizers encode ``space + text``. Byte offsets at which a token of either ends cut the tokens into groups. A text
falls into pieces at single spaces, where no token of either can lie across, so a piece that was met before is aligned
from memory. Links between an id and the id of the very same bytes (nearly all one-to-one groups) are counted in vectors
as long as the vocabulary; only the others are counted as pairs by a shuffle.
"""

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.sources.shared import shared_path

#: Pieces remembered by one Python worker before its memory is cleared, the longest of them, and characters aligned together.
REMEMBERED, LONGEST, CHARACTERS = 400_000, 64, 4 << 20
#: Most frequent pairs, with their counts, that every task holds (24 bytes each); the others are looked up by a join.
HEAD = 1 << 17

# Neither tokenizer has a token that holds a space behind a visible character.
_CUT = re.compile(r"(?<=\S) (?=\S)")

STORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "same array<int>, same_n array<int>, pairs array<long>, pairs_n array<int>")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair: long, n: int>>"


def byte_symbols() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Aligner:
    """Encodes texts by both tokenizers and aligns their tokens."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings are plain text
        symbols = byte_symbols()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(symbols[c] for c in names[i]) if i in names else b"" for i in range(max(names) + 1)]
        self.bytes_b = [self._bytes_b(i) for i in range(self.b.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b))
        places = sorted(range(len(self.bytes_b)), key=lambda i: not self.b.is_byte(i))  # a piece goes before a single byte
        by_bytes = {self.bytes_b[i]: i for i in places}
        #: For each id of A the id of B with the same bytes, else -1.
        self.identity = np.array([by_bytes.get(t, -1) if t else -1 for t in self.bytes_a], dtype=np.int64)
        self.known: dict[str, tuple] = {}

    def _bytes_b(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def _align(self, pieces: list[str]) -> list[tuple | None]:
        """Per piece (n_a, n_b, n_groups, n_links, groups, same, pairs), the last two as bytes of ids; None where bytes differ."""
        wholes = [" " + p for p in pieces]
        ids_a = [e.ids for e in self.a.encode_batch_fast(wholes, add_special_tokens=False)]
        ids_b = self.b.encode(pieces, num_threads=1)
        a, b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (ids_a, ids_b))
        until_a, until_b = (np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, wholes)), dtype=np.int64, count=len(wholes)))  # where pieces end
        whole = "".join(wholes).encode()
        table_a, table_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        if not len(a) or not len(b) or (ends_a[until_a - 1] != stops).any() or (ends_b[until_b - 1] != stops).any() or not (
                whole == b"".join(map(table_a, a.tolist())) == b"".join(map(table_b, b.tolist()))):
            good = [b"".join(map(table_a, x)) == w.encode() == b"".join(map(table_b, y)) for x, y, w in zip(ids_a, ids_b, wholes)]
            rest = [p for p, g in zip(pieces, good) if g]
            aligned = iter(self._align(rest) if rest else [])
            return [next(aligned) if g else None for g in good]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        steps = np.union1d(ends_a, ends_b)  # between two of them lies one token of either
        link_a, link_b = a[np.searchsorted(ends_a, steps)], b[np.searchsorted(ends_b, steps)]
        same = self.identity[link_a] == link_b
        same_bytes, pair_bytes = link_a[same].astype(np.int32).tobytes(), (link_a[~same] << 32 | link_b[~same]).tobytes()
        in_a, in_b = (np.searchsorted(x, cuts, side="right").tolist() for x in (ends_a, ends_b))
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups = [f"{text_a[s]}|{text_b[t]}" if e - s == 1 == f - t else f"{','.join(text_a[s:e])}|{','.join(text_b[t:f])}"
                  for s, e, t, f in zip([0, *in_a], in_a, [0, *in_b], in_b)]
        until = [until_a, until_b, *(np.searchsorted(x, stops, side="right") for x in (cuts, steps, steps[same], steps[~same]))]
        counts = [np.diff(u, prepend=0).tolist() for u in until[:4]]
        parts = []
        for values, u, width in ((groups, until[2], 1), (same_bytes, until[4], 4), (pair_bytes, until[5], 8)):
            edges = (u * width).tolist()
            parts.append([values[s:e] for s, e in zip([0, *edges], edges)])
        return list(zip(*counts, map(";".join, parts[0]), *parts[1:]))

    def _looked_up(self, pieces: list[str]) -> list[tuple | None]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, pieces, [False] * len(pieces)))
        new = [i for i, entry in enumerate(found) if entry is False]
        for s in range(0, len(new), 20_000):
            part = new[s : s + 20_000]
            for i, entry in zip(part, self._align([pieces[i] for i in part])):
                found[i] = entry
                if len(pieces[i]) <= LONGEST:
                    known[pieces[i]] = entry
        return found

    def documents(self, texts: list[str | None]) -> dict[str, list]:
        """Columns of STORED but the id, for texts aligned together."""
        cut = [_CUT.split(t) if t else [] for t in texts]
        codes, pieces = pd.factorize(np.array([p for c in cut for p in c], dtype=object))
        found = self._looked_up(pieces.tolist()) if len(pieces) else []
        bounds = np.cumsum([0, *map(len, cut)])
        bad = np.array([f is None for f in found], dtype=bool)
        broken = np.concatenate(([0], np.cumsum(bad[codes])))
        whole = broken[bounds[1:]] == broken[bounds[:-1]]
        if not whole.all():
            return self.documents([t if w else None for t, w in zip(texts, whole.tolist())])
        plain = [f or (0, 0, 0, 0, "", b"", b"") for f in found]
        out: dict[str, list] = {}
        for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
            total = np.concatenate(([0], np.cumsum(np.array([f[k] for f in plain], dtype=np.int64)[codes])))
            out[name] = pa.array(total[bounds[1:]] - total[bounds[:-1]])
        groups = np.empty(len(plain), dtype=object)
        groups[:] = [f[4] for f in plain]
        groups, edges = groups[codes].tolist(), bounds.tolist()
        out["groups_sha256"] = pa.array([hashlib.sha256(";".join(groups[s:e]).encode()).hexdigest() if e > s else ""
                                         for s, e in zip(edges, edges[1:])], type=pa.string())
        for k, name, kind in ((5, "same", np.int32), (6, "pairs", np.int64)):
            out[name], out[name + "_n"] = _distinct([f[k] for f in plain], kind, codes, bounds)
        return out


def _distinct(entries: list[bytes], kind, codes: np.ndarray, bounds: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """Per document its distinct values, ascending, and how often it holds each."""
    size = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // np.dtype(kind).itemsize
    flat = np.frombuffer(b"".join(entries), dtype=kind).astype(np.int64)
    each = size[codes]
    ends = np.concatenate(([0], np.cumsum(each)))
    values = flat[np.repeat((np.cumsum(size) - size)[codes] - ends[:-1], each) + np.arange(ends[-1])]
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(ends[bounds]))
    order = np.lexsort((values, doc)) if kind is np.int64 else np.argsort(doc << 32 | values, kind="stable")
    values, doc = values[order], doc[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    offsets = pa.array(np.searchsorted(doc[first], np.arange(len(bounds))).astype(np.int32))
    times = np.diff(np.append(first, len(values))).astype(np.int32)
    return (pa.ListArray.from_arrays(offsets, pa.array(values[first].astype(kind))), pa.ListArray.from_arrays(offsets, pa.array(times)))


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per Python worker and pair of files."""
    if (path_a, path_b) not in _ALIGNERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _stored(path_a: str, path_b: str):
    names = [f.split()[0] for f in STORED.split(", ")]

    def run(batches):
        align = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            s = 0
            while s < len(texts):
                e, size = s, 0
                while e < len(texts) and (e == s or size + len(texts[e] or "") <= CHARACTERS):
                    size += len(texts[e] or "")
                    e += 1
                columns = {"doc_id": batch.column(0).slice(s, e - s), **align.documents(texts[s:e])}
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
                s = e
    return run


def _same_counts(size: int):
    """One vector of counts per task, for the ids of the same bytes."""
    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column(0).flatten()), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["a", "n"])
    return run


def _pair_counts(batches):
    """Pairs of some documents with their counts, merged before they are shuffled."""
    held, size = [], 0

    def merged():
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], names=["pair", "n"])
    for batch in batches:
        held.append(np.asarray(batch.column(0).flatten()))
        size += len(held[-1])
        if size > 4_000_000:
            yield merged()
            held, size = [], 0
    if size:
        yield merged()


def _summed(same: np.ndarray, best: np.ndarray, head: np.ndarray, head_n: np.ndarray):
    """Sums over the links whose counts every task holds; pairs beyond are handed on."""
    def per_document(lists: pa.ListArray, values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        edges = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        return total[edges[1:]] - total[edges[:-1]]

    def run(batches):
        for batch in batches:
            ids, times = (np.asarray(batch.column(i).flatten(), dtype=np.int64) for i in (6, 7))
            pairs, pair_times = (np.asarray(batch.column(i).flatten(), dtype=np.int64) for i in (8, 9))
            at = np.minimum(np.searchsorted(head, pairs), max(len(head) - 1, 0))
            known = head[at] == pairs if len(head) else np.zeros(len(pairs), dtype=bool)
            n = np.where(known, head_n[at] if len(head) else 0, 0)
            count_sum = per_document(batch.column(6), same[ids] * times) + per_document(batch.column(8), n * pair_times)
            n_best = (per_document(batch.column(6), times * (same[ids] == best[ids]))
                      + per_document(batch.column(8), pair_times * (known & (n == best[pairs >> 32]))))
            left = per_document(batch.column(8), ~known)
            rest = pa.StructArray.from_arrays([pa.array(pairs[~known]), pa.array(pair_times[~known].astype(np.int32))], names=["pair", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(left))).astype(np.int32)), rest)
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(n_best), pa.array(count_sum), lists],
                                             names=[*batch.schema.names[:6], "n_best", "count_sum", "rest"])
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """A vector as long as the vocabulary, from at most one row per id."""
    table, out = rows.toArrow(), np.zeros(size, dtype=np.int64)
    out[table["a"].to_numpy()] = table["n"].to_numpy()
    return out


def report(docs: DataFrame, path_a: str, path_b: str, head_size: int = HEAD) -> DataFrame:
    """The contract's row per document.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte (U+2581 in the text), have
    zeros and no groups, and count for no pair. Repeated rows are documents of their own. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    stored = _written(texts.mapInArrow(_stored(path_a, path_b), STORED), "aligned")
    size = len(aligner(path_a, path_b).bytes_a)
    same = _vector(stored.select("same").mapInArrow(_same_counts(size), "a long, n long").groupBy("a").agg(F.sum("n").alias("n")), size)
    counted = _written(stored.select("pairs").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")),
                       "pair-counts")
    most = _vector(counted.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("n")), size)
    best = np.maximum(same, most)
    head = counted.orderBy(F.desc("n"), "pair").limit(head_size).toArrow()  # bounded by the parameter
    order = np.argsort(head["pair"].to_numpy())
    head_pairs, head_n = (head[c].to_numpy()[order] for c in ("pair", "n"))
    summed = _written(stored.mapInArrow(_summed(same, best, head_pairs, head_n), COUNTED)
                      .withColumn("row", F.monotonically_increasing_id()), "aligned-sums")

    highest = docs.sparkSession.createDataFrame(pa.table({"a": np.arange(size), "best": best}))  # as long as the vocabulary
    rest = (summed.select("row", F.explode("rest").alias("r")).select("row", "r.pair", F.col("r.n").cast("long").alias("times"))
            .join(counted, "pair").join(F.broadcast(highest), F.shiftright("pair", 32) == F.col("a")))
    more = rest.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"),
                                   F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    zero = F.lit(0).cast("long")
    return summed.drop("rest").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), "groups_sha256")
