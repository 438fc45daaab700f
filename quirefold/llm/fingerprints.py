"""Document fingerprints by consistent weighted sampling.

A document is its words weighted by their counts. For every sample and term, two gamma variates r and c (shape 2) and
a uniform shift b, drawn from a hash of both, turn the weight S into a level t = floor(ln S / r + b) and a rank
ln c - r (t - b + 1); the sample keeps the term of the smallest rank with its level. Two documents keep the same in a
sample with a chance equal to their generalised Jaccard similarity, the sum of smaller weights over that of larger.
"""

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import M1, UNIT_BYTES, id_cuts, joined, mix, range_of, text_bytes

SAMPLES = 64
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_BLOCK = 4096  # terms ranked at a time; a longer text goes block by block


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 at the middles of n equal steps."""
    x = np.concatenate((np.linspace(0, 1, 20_001)[:-1] ** 2, np.linspace(1, 40, 200_001)))
    return np.interp((np.arange(n) + 0.5) / n, 1 - (1 + x) * np.exp(-x), x)


_R = _gamma_quantiles(1 << 16).astype(np.float32)
_LN_C = np.log(_gamma_quantiles(1 << 16)).astype(np.float32)
_SHIFT = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)


class Sampler:
    def __init__(self, samples: int = SAMPLES, seed: int = 0):
        self.samples = samples
        self.seeds = np.random.default_rng(seed).integers(0, 1 << 64, samples, dtype=np.uint64)[:, None]

    def signatures(self, weightings: list[Counter]) -> list[np.ndarray]:
        """One 16-bit mark per sample for each weighting, 0 throughout where there are no terms.

        The variates of a term are drawn once for all weightings.
        """
        terms = sorted(set().union(*weightings))
        best = [np.full(self.samples, np.inf, dtype=np.float32) for _ in weightings]
        marks = [np.zeros(self.samples, dtype=np.uint64) for _ in weightings]
        rows = np.arange(self.samples)
        for at in range(0, len(terms), _BLOCK):
            block = terms[at : at + _BLOCK]
            hashes = pd.util.hash_array(np.array(block, dtype=object), categorize=False)
            lanes = mix((hashes[None, :] ^ self.seeds) * M1).view(np.uint16).reshape(
                self.samples, len(block), 4)
            r, shift = _R[lanes[:, :, 0]], _SHIFT[lanes[:, :, 1]]
            single = _LN_C[lanes[:, :, 2]] - r * (1 - shift)  # the rank at weight 1, where the level is 0
            for j, weights in enumerate(weightings):
                w = np.array(list(map(weights.__getitem__, block)), dtype=np.float32)  # 0 where a Counter has no such term
                rank = single.copy()
                rank[:, w == 0] = np.inf
                heavy = np.flatnonzero(w > 1)
                level = np.floor(np.log(w[heavy]) / r[:, heavy] + shift[:, heavy])
                rank[:, heavy] -= r[:, heavy] * level
                first = np.argmin(rank, axis=1)
                value = rank[rows, first]
                levels = np.zeros(rank.shape[1], dtype=np.int64)
                levels[heavy] = np.arange(len(heavy)) + 1
                chosen = levels[first]
                kept = np.where(chosen > 0, level[rows, chosen - 1], 0).astype(np.uint64) if len(heavy) else np.zeros(
                    self.samples, dtype=np.uint64)
                better = value < best[j]
                best[j] = np.where(better, value, best[j])
                marks[j] = np.where(better, joined(hashes[first], kept + np.uint64(1)), marks[j])
        return [self._short(m) if w else np.zeros(self.samples, dtype=np.uint16) for m, w in zip(marks, weightings)]

    @staticmethod
    def _short(marks: np.ndarray) -> np.ndarray:
        return ((marks >> np.uint64(40)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def of(self, text: str) -> np.ndarray:
        return self.signatures([terms(text)])[0]


def terms(text: str) -> Counter:
    """Words between white space, with their counts."""
    return Counter(text.split())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of samples that agree: an estimate of generalised Jaccard similarity; 1 for two texts without words."""
    return float((a == b).mean())


def as_text(signature: np.ndarray) -> str:
    """Four hexadecimal digits per sample."""
    return signature.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, samples: int = SAMPLES, seed: int = 0) -> DataFrame:
    """``doc_id, fingerprint`` of every row; no shuffle. A null text is empty."""
    def run(batches):
        sampler = Sampler(samples, seed)
        for batch in batches:
            marks = [as_text(sampler.of(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, type=pa.string())],
                                             names=["doc_id", "fingerprint"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _rows(units, sampler):
    """Result rows for an iterator of (unit, closing, doc_id, text) in order; a unit ends with its closing row."""
    # Signatures of a text and its edited version are drawn together, when the next text is there; the likeness to the
    # next text waits for that one's signature, so rows come out two texts late.
    waiting, last, done = None, None, None
    for unit, closing, doc, text in units:
        if done == unit:
            continue  # further rows of the closing id
        if last is not None:
            head, own, own_counts = last
            n = len(own) // 4
            edited = own[: len(own) - n] + text[:n] if n else own
            signature, changed = sampler.signatures([own_counts, terms(edited)])
            if waiting is not None:
                yield *waiting[0], likeness(waiting[1], signature)
            waiting = ((head, len(own), hashlib.sha256(edited.encode()).hexdigest(), as_text(signature),
                        as_text(changed), likeness(signature, changed)), signature)
        last = (doc, text, terms(text))
        if closing:
            if waiting is not None:
                yield *waiting[0], likeness(waiting[1], sampler.signatures([last[2]])[0])
            waiting, last, done = None, None, unit


def compare_with_edits(docs: DataFrame, samples: int = SAMPLES, seed: int = 0, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """The contract's row per document: fingerprints of the text and of its edited version, and two likenesses.

    Documents are laid out once in ranges of ascending ids; the first document of a range also goes to the end of the
    range before it (that of the first range to the last), so every document meets its successor. A null id comes
    first, rows that share an id follow each other in the order of their texts, and a single row succeeds itself.
    """
    n = max(1, -(-text_bytes(docs) // unit_bytes))
    cuts = id_cuts(docs, n)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = ids.withColumn("unit", range_of("doc_id", cuts) if cuts else F.lit(0))
    found = ranged.groupBy("unit").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null")).collect()
    firsts = sorted((r["unit"], None if r["null"] else r["first"]) for r in found)  # one row per range
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    null_closes = before.pop(None, -1)
    known = np.array(sorted(before), dtype=np.int64)
    closes = np.array([before[k] for k in sorted(before)] + [-1], dtype=np.int32)

    @F.pandas_udf("int")
    def closing_unit(column: pd.Series) -> pd.Series:
        present = column.notna().to_numpy()
        values = column.fillna(0).astype("int64").to_numpy()
        at = np.searchsorted(known, values)
        hit = (np.append(known, 0)[at] == values) & (at < len(known))
        return pd.Series(np.where(present, np.where(hit, closes[at], -1), null_closes).astype(np.int32))

    own = F.struct(F.col("unit").alias("unit"), F.lit(0).alias("closing"))
    copy = F.struct(F.col("closes").alias("unit"), F.lit(1).alias("closing"))
    placed = (ranged.withColumn("closes", closing_unit("doc_id"))
              .select("doc_id", "text", F.inline(F.when(F.col("closes") >= 0, F.array(own, copy)).otherwise(F.array(own)))))
    ordered = placed.repartition(n, "unit").sortWithinPartitions("unit", "closing", "doc_id", "text").select(
        "unit", "closing", "doc_id", "text")

    def run(batches):
        sampler = Sampler(samples, seed)
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        held = []
        for row in _rows(rows, sampler):
            held.append(row)
            if len(held) == 500:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)
    return ordered.mapInArrow(run, SCHEMA)


_KINDS = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in SCHEMA.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, type=_KINDS[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))
