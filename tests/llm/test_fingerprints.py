"""Weighted sampling: collision rate against generalised Jaccard, and successors against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from quirefold.llm import fingerprints


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate_is_generalised_jaccard():
    rnd = random.Random(3)
    sampler = fingerprints.Sampler(4096)
    for _ in range(12):
        a = Counter({f"t{rnd.randint(0, 60)}": rnd.randint(1, 9) for _ in range(40)})
        b = Counter({t: max(1, n + rnd.randint(-3, 3)) for t, n in a.items() if rnd.random() < 0.8})
        b.update({f"t{rnd.randint(0, 90)}": rnd.randint(1, 9) for _ in range(rnd.randint(0, 30))})
        x, y = sampler.signatures([a, b])
        assert abs(fingerprints.likeness(x, y) - jaccard(a, b)) < 0.035
        assert (x == sampler.signatures([a])[0]).all() and (y == sampler.signatures([b])[0]).all()


def test_long_texts_go_in_blocks(monkeypatch):
    sampler, a = fingerprints.Sampler(), Counter(f"w{i % 3000}" for i in range(9_999))
    whole = sampler.signatures([a])[0]
    monkeypatch.setattr(fingerprints, "_BLOCK", 128)
    assert (sampler.signatures([a])[0] == whole).all()


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    sampler, out = fingerprints.Sampler(), []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        a, b, c = map(sampler.of, (text, edited, following))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.as_text(a),
                    fingerprints.as_text(b), float((a == b).mean()), float((a == c).mean())))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_given_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for unit_bytes in (20_000, 1 << 23):
        assert found(fingerprints.compare_with_edits(docs, unit_bytes=unit_bytes)) == expected(rows)
    assert {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprints(docs).collect()} == {
        (r[0], r[3]) for r in expected(rows)}


def test_edges(spark, edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    for unit_bytes in (10_000, 1 << 23):
        assert found(fingerprints.compare_with_edits(edge, unit_bytes=unit_bytes)) == expected(rows)
    assert found(fingerprints.compare_with_edits(nothing)) == []
    one = spark.createDataFrame([(5, "only one text")], "doc_id long, text string")
    (row,) = found(fingerprints.compare_with_edits(one))
    assert row[:2] == (5, 13) and row[6] == 1.0


def test_edited_texts_are_near_and_next_ones_are_not(spark, sf):
    rows = fingerprints.compare_with_edits(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97
