"""Removal of repeated substrings, by bytes and by words, against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quirefold.llm import block_dedup, suffix_dedup
from quirefold.llm.common import in_units


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, length=50):
    """Strings by the smallest id they start in; null ids are smaller than all others."""
    key = lambda i: (i is not None, i or 0)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w not in first or key(i) < first[w]:
                first[w] = key(i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < key(i):
                gone[s : s + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return sorted(out, key=repr)


def brute_words(rows, length=20):
    rows = sorted(((i, (t or "").encode().split()) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first = {}
    for k, (_, w) in enumerate(rows):
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), (k, s))
    out = []
    for k, (i, w) in enumerate(rows):
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (k, s):
                gone[s : s + length] = [True] * length
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def planted(seed):
    """Texts of few words with shared passages of lengths around both thresholds, repeats inside and copies."""
    rnd = random.Random(seed)
    words = ["a", "bé", "cc", "ddd", "e"] if seed % 2 else [f"w{i}" for i in range(300)]
    shared = [" ".join(rnd.choice(words) for _ in range(n)) for n in (9, 10, 11, 19, 20, 21, 29, 60)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))))
            parts.append(rnd.choice(shared))
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 7)] + [(70, None), (71, ""), (72, "x"), (73, "\t \n")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("unit_bytes", [1_000, 1 << 20])
def test_planted(spark, seed, unit_bytes):
    rows = planted(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffix_dedup.report(docs, unit_bytes=unit_bytes)) == brute_bytes(rows)
    assert found(block_dedup.report(docs, unit_bytes=unit_bytes)) == brute_words(rows)


def test_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(suffix_dedup.report(docs, unit_bytes=40_000)) == brute_bytes(rows)
    assert found(block_dedup.report(docs, unit_bytes=40_000)) == brute_words(rows)


def test_edges(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found(suffix_dedup.report(edge, unit_bytes=30_000)) == brute_bytes(rows)
    assert found(block_dedup.report(edge, unit_bytes=30_000)) == brute_words(rows)
    assert found(suffix_dedup.report(nothing)) == [] and found(block_dedup.report(nothing)) == []


def test_outputs(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a {passage} b"), (2, f"c  {passage} d é")], "doc_id long, text string")
    assert dict(found(block_dedup.deduplicated(docs))) == {1: f"a {passage} b", 2: "c d é"}
    kept = {r.doc_id: bytes(r.content) for r in suffix_dedup.deduplicated(docs).collect()}
    assert kept == {1: f"a {passage} b".encode(), 2: "c d é".encode()} or kept[2] == "c d é".encode()


def test_texts_are_shuffled_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for report in (suffix_dedup.report, block_dedup.report):
        df = report(docs, unit_bytes=40_000)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReusedExchange") >= 2, plan


@pytest.mark.parametrize("unit_bytes", [60, 1 << 20])
def test_contents_that_agree_in_32_bits(spark, unit_bytes):
    """Two continuations of one passage, found by search, whose runs under its last anchor agree in half their hash."""
    passage = "the passage that a great many documents have in common, word for word, ends here: "
    rows = [(1, passage + "luczusruzvzkhizlrpuuuhmp"), (2, passage + "eeeiqcmxfdsempfwwlbmqbxj")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffix_dedup.report(docs, unit_bytes=unit_bytes)) == brute_bytes(rows)


def test_length_is_checked(spark):
    with pytest.raises(ValueError, match="at least 32"):
        suffix_dedup.report(spark.createDataFrame([(1, "x")], "doc_id long, text string"), length=20)


def test_long_neighbours_lie_in_units_of_their_own(spark):
    """Units hold about as many bytes each, wherever in the order of ids the long documents are."""
    size = F.when(F.col("id").between(2_000, 2_039), 100_000).otherwise(F.lit(100))
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, None), (5_000, None)], "doc_id long, text string"))
    units, n = in_units(docs, ["doc_id", "text"], 300_000)
    held = units.groupBy("unit").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                     F.count("*").alias("rows")).orderBy("unit").collect()
    assert n == 15 and sum(r.rows for r in held) == 4_002 and max(r.bytes or 0 for r in held) <= 500_000
    assert all(a.hi < b.lo for a, b in zip(held, held[1:]))
