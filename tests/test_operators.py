"""Golden and brute-force checks of the operators."""

import collections
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold.operators import cells, dedup, quality
from quirefold.operators.chunking import (cap_chunks, chunk_documents, estimate_tokens, merge_tail, recursive_chunks,
                                          split_text)
from quirefold.operators.embedding import HashingProvider, embed, embed_query, provider_factory, register_provider
from quirefold.operators.pages import assemble_pages
from quirefold.operators.select import expand_doc_types
from quirefold.operators.topk import batch_top_k, top_k

# Workers cannot import test modules: send what is defined here by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


# --- de-duplication -------------------------------------------------------------------------------

def test_first_wins_matches_brute_force_on_a_hot_key(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.4 else rng.choice(["", "a", "b", "c"])) for i in range(3000)]
    seen, expected = set(), []
    for i, h in rows:
        if not h or h not in seen:
            expected.append(i)
            seen.add(h)
    df = spark.createDataFrame(rows, "pos int, source_hash string").repartition(4)
    out = dedup.first_wins(df, ["pos"])
    assert sorted(r["pos"] for r in out.collect()) == expected
    # Copies are cut to one per task before they are shuffled.
    assert plan_of(out).count("WindowGroupLimit") >= 2


def test_skip_known_never_skips_an_empty_hash(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "b")], "k int, source_hash string")
    known = spark.createDataFrame([("a",), ("",)], "source_hash string")
    assert sorted(r["k"] for r in dedup.skip_known(df, known).collect()) == [2, 3]


def test_insert_if_absent_keeps_stored_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "x"), (2, "y")], "k int, v string")
    out = dedup.insert_if_absent(incoming, target, ["k"], ["v"])
    assert sorted(map(tuple, out.collect())) == [(1, "old"), (2, "x")]


def test_doc_types():
    assert expand_doc_types("all") == fv.DOC_TYPES and expand_doc_types(fv.DOC_TYPES[1]) == (fv.DOC_TYPES[1],)


# --- pages ----------------------------------------------------------------------------------------

def test_assemble_pages(spark):
    pages = spark.createDataFrame(
        [("d", 3, "b"), ("d", 1, "a"), ("d", 2, None), ("d", 4, ""), ("e", 1, ""), ("e", 2, None), ("f", 1, " x "),
         ("g", 1, "12345"), ("g", 2, "6")],
        "doc_key string, page_no int, text string")
    out = {r["doc_key"]: (r["text"], r["page_count"], r["error"]) for r in assemble_pages(pages, max_bytes=5).collect()}
    assert out["d"] == ("a\nb", 4, None) and out["f"] == ("x", 1, None) and "e" not in out
    assert out["g"][:2] == (None, 2) and "too large" in out["g"][2]


# --- constraints ----------------------------------------------------------------------------------

def test_validate(spark):
    documents = spark.createDataFrame(
        [(1, "u", "t", "ata", "h1"), (2, "u", None, "other", "h2"), (3, "u", "t", "ata", "h2"), (3, "u", "t", "ata", "h4")],
        "document_id long, url string, title string, doc_type string, source_hash string").withColumn(
        "ingested_at", F.current_timestamp())
    chunks = spark.createDataFrame(
        [(1, 0, "c", [1.0, 2.0]), (1, 0, "c", [1.0]), (9, 0, None, None)],
        "document_id long, chunk_index int, chunk_text string, embedding array<float>").select(
        "*", F.col("chunk_text").alias("cleaned_text"), F.lit("recursive").alias("chunk_strategy"),
        F.lit(1).alias("chunk_size"), F.lit(0).alias("chunk_overlap"), F.lit("h").alias("content_hash"),
        F.current_timestamp().alias("created_at"))
    found = sorted(map(tuple, quality.validate(documents, chunks, 2).collect()))
    assert found == sorted([
        ("not_null:title", "2", 1), ("in_set:doc_type", "2", 1), ("unique:source_hash", "h2", 2),
        ("unique:document_id", "3", 2), ("not_null:chunk_text", "9", 1), ("not_null:cleaned_text", "9", 1),
        ("unique:document_id,chunk_index,content_hash", "1|0|h", 2), ("references:document_id", "9", 1),
        ("dims:embedding", "1", 1)])


# --- chunking -------------------------------------------------------------------------------------

def _text(rng, n):
    words = ["w" * rng.randint(1, 12) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "\n", "\n\n"]) for w in words)


@pytest.mark.parametrize("seed", range(6))
def test_split_text_properties(seed):
    rng = random.Random(seed)
    text = _text(rng, 900) + "x" * (500 if seed % 2 else 0)
    for overlap in (0, 8):
        parts = split_text(text, 40, overlap)
        assert all(estimate_tokens(p) <= 40 for p in parts)
        assert all(p and p == p.strip() for p in parts)
        if not overlap:
            assert "".join("".join(parts).split()) == "".join(text.split())
        else:
            assert sum(map(len, parts)) > len(text) * 0.9
    assert split_text(text, 10 ** 6, 0) == [text.strip()]


def test_split_text_prefers_paragraphs_then_lines_then_words():
    assert split_text("a" * 30 + "\n\n" + "b" * 30, 10, 0) == ["a" * 30, "b" * 30]
    assert split_text("a" * 30 + "\n" + "b" * 30, 10, 0) == ["a" * 30, "b" * 30]
    assert split_text("a" * 30 + " " + "b" * 30, 10, 0) == ["a" * 30, "b" * 30]
    assert split_text("a" * 100, 10, 0) == ["a" * 43, "a" * 43, "a" * 14]


def test_split_text_overlap_repeats_whole_pieces():
    words = [f"{i:03d}" for i in range(40)]
    parts = split_text(" ".join(words), 10, 3)
    assert all(b.split()[0] in a.split() for a, b in zip(parts, parts[1:]))
    assert list(dict.fromkeys(w for p in parts for w in p.split())) == words


def test_other_length_function(column):
    assert column(["a b c d e"], lambda x: recursive_chunks(x, 2, 0, lambda s: len(s.split()))) == [["a b", "c d", "e"]]


def test_merge_and_cap(spark):
    def run(chunks):
        df = spark.createDataFrame([(chunks,)], "c array<string>")
        return df.select(cap_chunks(merge_tail(F.col("c"), 500, 0.5))).first()[0]

    assert run(["a" * 2000, "b" * 999]) == ["a" * 2000 + " " + "b" * 999]
    assert run(["a" * 2000, "b" * 1000]) == ["a" * 2000, "b" * 1000]
    assert run(["short"]) == ["short"] and run([]) == []
    assert len(run(["a" * 2000] * 1001 + ["b"])) == 1000
    assert len(run(["a" * 2000] * 999 + ["b"])) == 999


def test_chunk_documents_guards(spark):
    df = spark.createDataFrame([(1, " \n"), (2, None), (3, "é" * 6), (4, "a b")], "k int, text string")
    out = chunk_documents(df, "text", max_bytes=11)
    assert [tuple(r) for r in out.collect()] == [(4, 0, "a b")]
    for bad in ("sentence", ""):
        with pytest.raises(ValueError, match="strategy"):
            chunk_documents(df, "text", bad)
    with pytest.raises(ValueError, match="overlap"):
        chunk_documents(df, "text", "window", 10, 10)


def test_oversize_guard_at_its_real_limit(spark):
    df = spark.range(2).select(F.col("id").alias("k"), F.concat(F.repeat(F.lit("word "), 2 * 1024 * 1024),
                                                               F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("text"))
    out = chunk_documents(df, "text", "window", 100, 0)
    assert [tuple(r) for r in out.groupBy("k").count().collect()] == [(0, 1000)]


# --- embedding ------------------------------------------------------------------------------------

@register_provider("flaky")
class Flaky:
    """Fails on batches that hold a bad text."""

    model = "flaky"
    dimensions = 2

    def embed_text(self, text):
        if "bad" in text:
            raise RuntimeError("cannot embed " + text)
        return [1.0] if "short" in text else [float(len(text)), 1.0]

    def embed_batch(self, texts):
        return [self.embed_text(t) for t in texts]


def test_embed_falls_back_to_single_texts(spark):
    rows = [(i, "bad" if i == 70 else "short" if i == 90 else "t" * (i + 1)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, cleaned_text string").coalesce(1)
    out = {r["k"]: r for r in embed(df, provider="flaky").collect()}
    assert len(out) == 120
    assert all(out[i]["embedding"] == [float(i + 1), 1.0] for i in out if i not in (70, 90))
    assert out[70]["embedding"] is None and "cannot embed bad" in out[70]["embed_error"]
    assert out[90]["embedding"] is None and "1 dimensions, expected 2" in out[90]["embed_error"]
    with pytest.raises(Exception, match="cannot embed bad"):
        embed(df, provider="flaky", fail_fast=True).collect()


def test_provider_registry():
    with pytest.raises(ValueError, match="'nope'.*flaky.*hashing"):
        provider_factory("nope")
    assert HashingProvider(8).embed_batch([]) == []


def test_hashing_provider(spark):
    texts = ["The cat", "the  CAT", "a dog", ""]
    a, b, c, empty = HashingProvider(64).embed_batch(texts)
    assert a == b != c and empty == [0.0] * 64
    assert abs(np.linalg.norm(a) - 1) < 1e-6 and embed_query(spark, "the cat", dims=64) == a


# --- nearest neighbours ---------------------------------------------------------------------------

def _brute(vectors, queries, k):
    def unit(v):
        v = np.asarray(v, dtype=float)
        n = np.linalg.norm(v)
        return v / n if n else None

    out = {}
    for q, qv in queries:
        scored = []
        for key, v in vectors:
            u = None if v is None else unit(v)
            scored.append((key, None if u is None else float(u @ unit(qv))))
        scored.sort(key=lambda s: (s[1] is None, -round(s[1], 9) if s[1] is not None else 0, s[0]))
        out[q] = [(key, None if s is None else round(s, 6)) for key, s in scored[:k]]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(400)]
    # A third of the rows are copies of one vector: ties must be broken by key, none may be lost.
    rows += [(400 + i, rows[7][1]) for i in range(200)]
    return rows + [(600, None), (601, [0.0] * 8)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k long, embedding array<float>")


def test_top_k_with_ties_and_missing(spark, vectors):
    df, query = _frame(spark, vectors).repartition(4), vectors[7][1]
    for k in (5, 300, 1000):
        got = [(r["k"], r["similarity"] if r["similarity"] is None else round(r["similarity"], 6))
               for r in top_k(df, query, k, ["k"]).collect()]
        assert got == _brute(vectors, [(0, query)], k)[0]
    assert "TakeOrderedAndProject" in plan_of(top_k(df, query, 5, ["k"]))


def _grouped(frame):
    out = collections.defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["k"], r["similarity"] if r["similarity"] is None else round(r["similarity"], 6)))
    return dict(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 8 * 8 * 6])
def test_batch_top_k_equals_brute_force(spark, vectors, block_bytes):
    queries = vectors[:23]
    q = _frame(spark, queries).withColumnRenamed("k", "query_id")
    df = _frame(spark, vectors).repartition(4)
    for k in (3, 1000):
        assert _grouped(batch_top_k(df, q, k, ["k"], block_bytes=block_bytes)) == _brute(vectors, queries, k)


def test_batch_top_k_without_queries(spark, vectors):
    q = _frame(spark, []).withColumnRenamed("k", "query_id")
    assert batch_top_k(_frame(spark, vectors), q, 3, ["k"]).count() == 0


def test_cells(spark, vectors, tmp_path):
    df = _frame(spark, vectors).repartition(4)
    centroids = cells.train_cells(df, 6)
    assigned = cells.assign_cells(df, centroids)
    assert {r["cell"] for r in assigned.where("k >= 600").collect()} == {cells.NO_CELL}
    path = str(tmp_path / "cells")
    # Adaptive execution would merge partitions as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    cells.write_cells(assigned, path, ["k"], rows_per_file=50)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    indexed = spark.read.parquet(path)
    assert indexed.count() == len(vectors)
    # The cell that holds the copies is written by several tasks.
    sizes = collections.Counter(r["cell"] for r in indexed.select("cell").collect())
    hot = sizes.most_common(1)[0][0]
    assert len(list((tmp_path / "cells" / f"cell={hot}").glob("*.parquet"))) > 1

    queries = vectors[:10]
    q = _frame(spark, queries).withColumnRenamed("k", "query_id")
    full = cells.approx_batch_top_k(indexed, centroids, q, 5, nprobe=6, keys=["k"])
    assert _grouped(full) == _brute(vectors, queries, 5)
    assert [r["k"] for r in cells.approx_top_k(indexed, centroids, queries[3][1], 5, 6, ["k"]).collect()] == \
        [k for k, _ in _brute(vectors, queries, 5)[3]]
    few = _grouped(cells.approx_batch_top_k(indexed, centroids, q, 5, nprobe=2, keys=["k"]))
    assert all(few[k][0][1] == 1.0 for k, _ in queries)
    one = cells.approx_top_k(indexed, centroids, queries[3][1], 5, 1, ["k"])
    assert re.search(r"PartitionFilters: \[[^]]*cell", plan_of(one))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_cells_recall(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").repartition(4, "vec_id")
    q = v.where("vec_id % 40 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    centroids = cells.train_cells(v, 32)
    assigned = cells.assign_cells(v, centroids).cache()
    exact = batch_top_k(v, q, 10, ["vec_id"]).select("query_id", "vec_id")
    near = cells.approx_batch_top_k(assigned, centroids, q, 10, 8, ["vec_id"]).select("query_id", "vec_id")
    assert exact.join(near, ["query_id", "vec_id"]).count() / exact.count() >= 0.6
    sizes = {r["cell"]: r["count"] for r in assigned.groupBy("cell").count().collect()}
    vectors = np.array([r["embedding"] for r in q.collect()])
    mask = cells._probed(vectors, centroids, 8)
    scanned = sum(sizes.get(c, 0) for row in mask for c in np.flatnonzero(row)) / len(vectors)
    assert scanned / v.count() <= 0.3


def test_blocks_of_queries_cost_no_jobs(spark, vectors):
    q = _frame(spark, vectors).withColumnRenamed("k", "query_id")
    df = _frame(spark, vectors).repartition(4)
    group = "blocks of queries"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = batch_top_k(df, q, 3, ["k"], block_bytes=8 * 8 * 2)
        rows = _grouped(found)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert rows == _brute(vectors, [(k, v) for k, v in vectors if v is not None and any(v)], 3) | {601: [(k, None) for k in range(3)]}
    assert jobs < 30  # and not one for every two queries


def test_a_block_of_queries_bounds_the_memory_of_a_scan():
    import tracemalloc

    import pyarrow as pa

    from quirefold.functions.vectors import unit_rows
    from quirefold.operators import topk

    rng = np.random.default_rng(3)
    units, rows = unit_rows(rng.normal(size=(20_000, 16))), rng.normal(size=(1_500, 16))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), 16).cast(pa.list_(pa.float64()))],
                                       names=["key0", "vector"])
    tracemalloc.start()
    found = list(topk._scan_rows(iter([batch]), np.arange(len(units)), units, None, 5, ["key0"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in found) == 5 * len(units)
    assert peak < 100 << 20  # all scores of a tile of rows would be 160 MB, and several copies of them


@pytest.mark.parametrize("nprobe", [2, 6])
def test_cells_in_blocks(spark, vectors, nprobe):
    """A set of queries that takes several blocks finds the same rows as one that is held whole."""
    df = _frame(spark, vectors).repartition(4)
    centroids = cells.train_cells(df, 6)
    indexed = cells.assign_cells(df, centroids)
    q = _frame(spark, vectors).withColumnRenamed("k", "query_id")
    one, many = (_grouped(cells.approx_batch_top_k(indexed, centroids, q, 4, nprobe, ["k"], block_bytes=b)) for b in (1 << 20, 8 * 8 * 5))
    assert one == many and len(one) == sum(v is not None for _, v in vectors)


def test_hashed_vectors_of_a_batch():
    """Words are looked up in bulk; the vectors are those of the definition, word by word."""
    import hashlib

    texts = ["", "a b  A\nß straße", "x " * 300, "İstanbul a", " "]
    got = HashingProvider(dims=16).embed_batch(texts)
    for text, vector in zip(texts, got):
        sums = np.zeros(16)
        for word in text.lower().split():
            digest = hashlib.md5(word.encode("utf-8")).hexdigest()
            sums[int(digest[:8], 16) % 16] += 1 if int(digest[8], 16) < 8 else -1
        norm = np.sqrt((sums * sums).sum())
        assert vector == (sums / (norm or 1)).astype(np.float32).tolist()


def test_vectors_of_a_batch_are_no_python_objects():
    import tracemalloc

    import pyarrow as pa

    from quirefold.operators.embedding import _embedded

    texts = pa.array([f"a{i % 7} b" for i in range(4_000)] + [None])
    provider = HashingProvider(dims=256)
    tracemalloc.start()
    done = _embedded(provider, texts, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done.field("embedding").to_pylist() == provider.embed_batch(texts.drop_null().to_pylist()) + [None]
    assert done.field("error").null_count == len(texts)
    assert peak < 50 << 20  # a million floats as Python objects with their lists are more than that beside the counts
