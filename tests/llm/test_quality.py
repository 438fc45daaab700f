"""The network: gradients, chunks, accuracy on held-out rows."""

import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirefold.llm import quality
from quirefold.llm.quality import Network

TEXTS = [b"hello world" * 40, b"", b"abc", bytes(range(256)) * 9]


def test_gradient_by_differences():
    net, rng = Network.fresh(3), np.random.default_rng(0)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    wanted = np.array([1.0, 0, 1, 0])

    def loss():
        z = net.forward(TEXTS)
        return np.mean(np.log1p(np.exp(-z)) * wanted + np.log1p(np.exp(z)) * (1 - wanted))
    found = net.gradient(TEXTS, wanted)
    for name, values in net.weights.items():
        for _ in range(6):
            i = tuple(rng.integers(0, s) for s in values.shape)
            kept = values[i]
            values[i] = kept + 1e-5
            up = loss()
            values[i] = kept - 1e-5
            down = loss()
            values[i] = kept
            assert abs((up - down) / 2e-5 - found[name][i]) < 1e-4


def brute_logit(net, text):
    """Filters, chunks and pools written out position by position."""
    w = {k: v.astype(np.float64) for k, v in net.weights.items()}
    data = text + b"\0" * (max(len(text), quality.WIDTH) - len(text))
    n = -(-(len(data) - quality.WIDTH) // quality.STRIDE) + 1
    data += b"\0" * quality.STRIDE
    acts = []
    for p in range(n):
        x = w["embed"][list(data[p * 4 : p * 4 + 8])].reshape(-1)
        acts.append(np.maximum(x[:32] @ w["early"] + x[32:] @ w["late"] + w["bias"], 0))
    chunks = [np.max(acts[s : s + quality.STEP + quality.OVERLAP], axis=0) for s in range(0, n, quality.STEP)]
    features = np.concatenate((np.max(chunks, axis=0), np.mean(chunks, axis=0)))
    return np.maximum(features @ w["dense"] + w["dense_bias"], 0) @ w["out"] + w["out_bias"][0]


def test_forward_covers_whole_texts():
    net, rng = Network.fresh(1), np.random.default_rng(1)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 7, 8, 9, 12, 447, 448, 449, 450, 452, 510, 896, 897, 900, 1345, 5000)]
    together = net.forward(texts)
    for text, z in zip(texts, together):
        assert abs(z - brute_logit(net, text)) < 1e-3
    assert np.allclose(net.scores(texts), [1 / (1 + np.exp(-float(net.forward([t])[0]))) for t in texts], atol=1e-5)


def test_scoring_needs_memory_for_a_few_chunks():
    """A text much longer than a tile is scored as when all its filters are in memory, without having them there."""
    net, rng = Network.fresh(1), np.random.default_rng(2)
    size = quality.STEP * quality.STRIDE
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (3, 900, quality._TILE * size, 5, quality._TILE * size + 61, 2 << 20)]
    assert np.allclose(net.forward(texts), net.forward(texts, keep=True)[0], atol=1e-4)
    tracemalloc.start()
    net.scores(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 << 20


@pytest.fixture(scope="module")
def rows(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet".replace("sf0.001", "sf0.01")) for n in ("documents", "labels"))
    return docs, labels, quality.report(docs, labels)


def test_held_out_accuracy(rows):
    docs, labels, report = rows
    got = {r.doc_id: r for r in report.collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    test = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in test if q], [s for s, q in test if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_scores_use_texts_only(spark, rows):
    docs, labels, report = rows
    network = quality.trained(docs, labels)
    moved = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).repartition(3)
    a = {r.doc_id: r.score for r in quality.scored(docs, network).collect()}
    b = {r.doc_id: r.score for r in quality.scored(moved, network).collect()}
    assert all(abs(a[i] - b[i]) < 1e-4 for i in a)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.trained(docs, flipped)
    assert all(np.array_equal(again.weights[k], network.weights[k]) for k in network.weights)


def test_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, 0), (8, 1, 0), (9, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    assert len(quality.report(edge, labels).collect()) == 12
    assert quality.report(nothing, labels).collect() == []
    unlabelled = quality.report(edge, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {1.0} and {r.predicted for r in unlabelled} == {1}
    assert quality.kept(edge, labels.limit(0)).columns == edge.columns
    assert quality.kept(edge, labels.limit(0)).count() == 12
