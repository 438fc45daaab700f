"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded and passed through learned filters over the whole document. Filters are pooled by their maximum
within overlapping chunks; the chunks' maxima and means over the document go through a small dense layer into one
probability. The network is fitted on a bounded sample of labelled rows and scores every document where it lies.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold.llm.common import carried

#: Labelled rows that the network is fitted on at most, and the longest of them in bytes.
FIT_ROWS, FIT_BYTES = 3_000, 1 << 16
EPOCHS, BATCH, RATE = 16, 32, 3e-3
THRESHOLD = 0.3

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 4, 32, 16
STEP = 112  # filter positions from one chunk to the next: 448 bytes
OVERLAP = 15  # positions of the next chunk that a chunk covers as well: 60 bytes, more than a filter's width
_INFER_BYTES = 1 << 20
_TILE = 512  # chunks whose filters are in memory at a time when texts are scored


@dataclass
class Network:
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 0) -> "Network":
        rng = np.random.default_rng(seed)
        shapes = {"embed": (256, EMBED), "early": (STRIDE * EMBED, FILTERS), "late": (STRIDE * EMBED, FILTERS),
                  "bias": (FILTERS,), "dense": (2 * FILTERS, HIDDEN), "dense_bias": (HIDDEN,), "out": (HIDDEN,), "out_bias": (1,)}
        return cls({k: (rng.normal(0, 1 if k == "embed" else 1.4 / np.sqrt(s[0]), s) if "bias" not in k
                        else np.zeros(s)).astype(np.float32) for k, s in shapes.items()})

    def forward(self, texts: list[bytes], keep: bool = False):
        """Logits of texts; with ``keep`` also what the gradient needs."""
        w = self.weights
        sizes = np.array([max(len(t), WIDTH) for t in texts])
        positions = -(-(sizes - WIDTH) // STRIDE) + 1  # the last filter may reach into padding
        chunks = -(-positions // STEP)
        slots = -(-(positions + 1) // STEP)  # room for the whole text: sometimes one more than its chunks
        starts = np.concatenate(([0], np.cumsum(slots)))
        data = np.zeros((starts[-1] * STEP + 1) * STRIDE, dtype=np.uint8)
        for text, at in zip(texts, starts):
            data[at * STEP * STRIDE : at * STEP * STRIDE + len(text)] = np.frombuffer(text, dtype=np.uint8)
        left = np.repeat(positions, slots) - (np.arange(starts[-1]) - np.repeat(starts[:-1], slots)) * STEP
        pooled, heads, tile = [], [], starts[-1] if keep else _TILE
        for first in range(0, starts[-1], tile):
            last = min(first + tile, starts[-1])
            groups = w["embed"][data[first * STEP * STRIDE : (last * STEP + 1) * STRIDE]].reshape(-1, STRIDE * EMBED)
            act = groups[:-1] @ w["early"]
            act += groups[1:] @ w["late"]
            act += w["bias"]
            np.maximum(act, 0, out=act)
            act = act.reshape(-1, STEP, FILTERS)
            for slot in np.flatnonzero(left[first:last] < STEP):
                act[slot, max(left[first + slot], 0) :] = 0  # after the text; 0 is the least value
            pooled.append(act.max(axis=1))
            heads.append(act[:, :OVERLAP].max(axis=1))
        ends = starts[:-1] + chunks - 1
        pooled, heads = np.concatenate(pooled), np.concatenate(heads)
        following = np.zeros_like(pooled)
        following[:-1] = heads[1:]
        following[ends] = following[starts[1:] - 1] = 0
        top = np.maximum(pooled, following)
        most = np.maximum.reduceat(top, starts[:-1])
        mean = np.add.reduceat(top, starts[:-1]) / chunks[:, None].astype(np.float32)
        features = np.concatenate((most, mean), axis=1)
        hidden = np.maximum(features @ w["dense"] + w["dense_bias"], 0)
        logits = hidden @ w["out"] + w["out_bias"][0]
        if not keep:
            return logits
        place = np.where(following > pooled, act[np.minimum(np.arange(len(act)) + 1, len(act) - 1), :OVERLAP].argmax(axis=1) + STEP,
                         act.argmax(axis=1)) + (np.arange(len(act)) * STEP)[:, None]
        return logits, (data, groups, top, place, starts, slots, chunks, most, features, hidden)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text, in batches of bounded size; a longer text makes its own batch."""
        out, held, size = [], [], 0
        for text in texts:
            if held and size + len(text) > _INFER_BYTES:
                out.append(self.forward(held))
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            out.append(self.forward(held))
        return 1 / (1 + np.exp(-np.concatenate(out).astype(np.float64))) if out else np.zeros(0)

    def gradient(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss; the maxima pass it to the places they came from."""
        w = self.weights
        logits, (data, groups, top, place, starts, slots, chunks, most, features, hidden) = self.forward(texts, keep=True)
        d_logit = ((1 / (1 + np.exp(-logits)) - labels) / len(texts)).astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (hidden > 0)
        d_features = d_hidden @ w["dense"].T
        doc = np.repeat(np.arange(len(texts)), slots)
        d_top = d_features[doc, FILTERS:] / chunks[doc][:, None].astype(np.float32)
        at_most = top == most[doc]
        ties = np.add.reduceat(at_most, starts[:-1], dtype=np.float32)
        d_top += np.where(at_most, d_features[doc, :FILTERS] / ties[doc], 0)
        d_top *= top > 0
        early, late = groups[place], groups[place + 1]  # chunk, filter, value
        d_embed = np.zeros((256, EMBED), dtype=np.float32)
        for part, name in ((0, "early"), (1, "late")):
            back = d_top[:, :, None] * w[name].T[None]
            read = data.reshape(-1, STRIDE)[place + part].reshape(-1)
            back = back.reshape(-1, EMBED)
            for e in range(EMBED):
                d_embed[:, e] += np.bincount(read, weights=back[:, e], minlength=256)
        return {"embed": d_embed, "early": np.einsum("cf,cfv->vf", d_top, early), "late": np.einsum("cf,cfv->vf", d_top, late),
                "bias": d_top.sum(axis=0), "dense": features.T @ d_hidden, "dense_bias": d_hidden.sum(axis=0),
                "out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 0) -> Network | None:
    """A network fitted by Adam; None without labels."""
    if not texts:
        return None
    net, rng = Network.fresh(seed), np.random.default_rng(seed + 1)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    wanted, step = np.array(labels, dtype=np.float32), 0
    n_steps = max(epochs * -(-len(texts) // BATCH), 400)  # a small sample is gone through more often
    while step < n_steps:
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            if step == n_steps:
                break
            step += 1
            chosen = order[at : at + BATCH]
            rate = RATE * min(1, step / 20) * (1 - step / n_steps) ** 0.5
            for k, g in net.gradient([texts[i] for i in chosen], wanted[chosen]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net.weights[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def held_out(key: Column) -> Column:
    """Rows that no label is learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Network | None:
    """A network fitted on so many labelled rows, those with the smallest hashes of ids, none of them held out.

    Rows without a label or id are left out, and texts beyond FIT_BYTES are not fitted on (they are scored whole). Of
    rows that share an id the text with the smallest hash is taken.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = (usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    text = F.coalesce(F.col("text"), F.lit(""))
    # One text per id, so no more rows than the sample has and no more bytes than FIT_BYTES each.
    found = (docs.select("doc_id", text.cast("binary").alias("text")).where(F.octet_length(text) <= FIT_BYTES)
             .join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality")
             .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")).collect())
    found.sort(key=lambda r: (r.doc_id, bytes(r.text)))
    return fit([bytes(r.text) for r in found], [int(r.quality > 0) for r in found])


def scored(rows: DataFrame, network: Network | None, key: str = "doc_id") -> DataFrame:
    """One column of the rows with ``score``, for the whole ``text`` of every row; a null text is empty.

    Without a network, there having been no labels, every score is 1 and nothing is rejected.
    """
    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = (batch.slice(at, 1_000).to_pylist() for at in range(0, len(batch), 1_000))
            scores = [network.scores(texts) if network else np.ones(len(texts)) for texts in parts]
            yield pa.array(np.concatenate(scores) if scores else np.zeros(0), type=pa.float64())
    return rows.select(key, score(F.coalesce("text", F.lit("")).cast("binary")).alias("score"))


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's row per document."""
    out = scored(docs, trained(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that the network does not reject."""
    every = carried(docs, "doc_id", "text")
    return every.back(scored(every.rows, trained(every.rows, labels), "row").where(F.col("score") >= threshold))
