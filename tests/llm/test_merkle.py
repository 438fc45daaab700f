"""The manifest and its proofs against plain Python and SQL."""

import hashlib
import zlib

import oracle
import pytest
from pyspark.sql import functions as F

from quirefold.llm import merkle
from quirefold.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climb(nodes, at, claimed):
    """Root, siblings met and root refolded from another leaf."""
    siblings = []
    while len(nodes) > 1:
        run = range(at // 3 * 3, min(len(nodes), at // 3 * 3 + 3))
        siblings += [nodes[i] for i in run if i != at]
        claimed = h(*[claimed if i == at else nodes[i] for i in run])
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], siblings, claimed


def plain(rows):
    by = {}
    for r in rows:
        true = leaf(r, r["text"])
        changed = r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
        by.setdefault(r["source"], []).append((r["doc_id"], true, leaf(r, r["text"].replace("\n", "")) if changed else true))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
    roots = [climb([m[1] for m in by[s]], 0, "")[0] for s in order]
    out = []
    for no, s in enumerate(order):
        for at, (doc, true, claimed) in enumerate(by[s]):
            subroot, low, folded = climb([m[1] for m in by[s]], at, claimed)
            root, high, folded = climb(roots, no, folded)
            out.append((doc, true, subroot, root, h(*low, *high), folded, folded == root))
    return sorted(out, key=repr)


def got(frame):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_equals_sql(spark, sf):
    assert oracle.compare(QUERIES["op12_merkle_manifest"](spark, sf), oracle.connect(sf), merkle.SQL) == []


@pytest.mark.parametrize("held", [0, 4, merkle.HELD_RUNS])
def test_many_shapes_of_trees(spark, monkeypatch, held):
    """Sources of 1, 2, 3, 4, 9, 10, 28 and 300 documents; all, some and none of the runs met by shuffling."""
    monkeypatch.setattr(merkle, "HELD_RUNS", held)
    rows, doc = [], 0
    for no, n in enumerate((1, 2, 3, 4, 9, 10, 28, 300)):
        for _ in range(n):
            doc += 1
            rows.append((doc, f"line {doc}\nnext" if doc % 3 else "no feed", "en", f"src é{no}", doc))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.report(docs)) == plain(rows_of(docs))
    assert {r.verified for r in merkle.report(docs).collect()} == {True, False}


def test_edges(spark, edge):
    rows = [(1, "a\nb", None, None, None), (None, "x\n", "en", None, 1), (None, None, "", "", 0), (2, None, None, "s", -5),
            (7, "same\n", "d", "s", 1), (7, "same\n", "d", "s", 1), (7, "other", "d", "s", 1), (8, "", "é", "S", 2),
            (9, "\n" * 300_000 + "long", "en", "t", None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("u")).withColumn("up", F.lit(1)).withColumn("level", F.lit("x"))
    assert got(merkle.report(docs)) == plain(rows_of(docs))
    one = docs.where("doc_id = 1")
    assert got(merkle.report(one)) == plain(rows_of(one))
    assert merkle.report(docs.limit(0)).collect() == []


def test_root_does_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert merkle.build(docs).root == merkle.build(docs.repartition(7, "text")).root
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) in (None, "1000000")


def test_nodes_are_stored_in_blocks(spark, monkeypatch):
    """300 leaves of one source: four blocks of up to 81 and one above, not six levels of runs; every leaf climbs in two steps."""
    docs = spark.createDataFrame([(i, f"t{i}\n", "en", "s", i) for i in range(300)], SCHEMA)
    manifest = merkle.build(docs)
    assert {r["level"]: r["count"] for r in manifest.runs.groupBy("level").count().collect()} == {1: 4, 2: 1}
    stored, climb_ = [], merkle.climb
    monkeypatch.setattr(merkle, "climb", lambda *a, **k: stored.append(climb_(*a, **k)) or stored[-1])
    assert merkle.proofs(manifest).count() == 300
    assert sum(s.count() for s in stored) == 300 + 4 * 2  # last steps, and what the first leaf of a block met


@pytest.mark.parametrize("held", [0, merkle.HELD_RUNS])
def test_more_sources_than_a_block_holds(spark, monkeypatch, held):
    monkeypatch.setattr(merkle, "HELD_RUNS", held)
    rows = [(i, f"a\n{i}", "en", f"s{i % 100 if i < 190 else 7}", i) for i in range(290)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.report(docs)) == plain(rows_of(docs))
