"""Fingerprints, covering and components against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quirefold.llm import simhash
from quirefold.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(items, linked):
    """Smallest id reachable for (id, value) pairs."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(items))]


def expected(rows):
    items = [(i, brute_fingerprint(t)) for i, t in rows]
    found = brute_components(items, lambda a, b: (a ^ b).bit_count() <= 3)
    return sorted(((i, f"{fp:016x}", c) for (i, fp), c in zip(items, found)), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hash_is_sparks(spark):
    (row,) = spark.createDataFrame([("a b ç",)], "s string").select(F.xxhash64("s").alias("h")).collect()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("a b ç".encode(), seed=42)


def test_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = expected(rows)
    assert found(simhash.near_duplicates(docs)) == wanted
    left = simhash.representatives(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in wanted})


def test_edges(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found(simhash.near_duplicates(edge)) == expected(rows)
    left = simhash.representatives(edge).collect()
    assert len(left) == len({c for _, _, c in expected(rows)} - {None}) + len({f for i, f, c in expected(rows) if c is None})
    assert found(simhash.near_duplicates(nothing)) == [] and simhash.representatives(nothing).collect() == []


def test_covering_guarantee():
    rng = np.random.default_rng(5)
    covering = simhash.Covering()
    fps = rng.integers(0, 1 << 64, 1_000, dtype=np.uint64)
    fps[0], fps[1] = 0, (1 << 64) - 1

    def sets(values):
        out = [set() for _ in values]
        for anchor, owner in zip(*(x.tolist() for x in covering.copies(values))):
            out[owner].add(anchor)
        return out
    own = sets(fps)
    for bits in (1, 2, 3):
        changed = fps.copy()
        for i in range(len(fps)):
            for b in rng.choice(64, bits, replace=False):
                changed[i] ^= np.uint64(1 << int(b))
        assert all(a & b for a, b in zip(own, sets(changed)))


def test_dense_groups_and_chains(spark):
    """Hundreds of fingerprints around one centre, chains of three-bit steps, and lone ones."""
    rnd = random.Random(11)
    centre, values = rnd.getrandbits(64), set()
    for _ in range(700):
        v = centre
        for _ in range(rnd.randint(0, 5)):
            v ^= 1 << rnd.randrange(64)
        values.add(v)
    at = rnd.getrandbits(64)
    for _ in range(60):
        for b in rnd.sample(range(64), 3):
            at ^= 1 << b
        values.add(at)
    values |= {rnd.getrandbits(64) for _ in range(300)}
    items = list(enumerate(sorted(values)))
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in items]
    rows = spark.createDataFrame(signed, "doc_id long, fp long")
    roots = {r.fp: r.root for r in simhash.classes(rows).collect()}
    names = {}
    for i, v in signed:
        names.setdefault(roots[v], i)
    assert [names[roots[v]] for _, v in signed] == brute_components(items, lambda a, b: (a ^ b).bit_count() <= 3)


def test_components_of_random_links(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    pairs += [(2000, i) for i in range(2001, 2300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
    linked = {frozenset(p) for p in pairs}
    assert [got[n] for n in nodes] == brute_components([(n, n) for n in nodes], lambda a, b: frozenset((a, b)) in linked)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
