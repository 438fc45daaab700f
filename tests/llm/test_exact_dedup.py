"""Exact deduplication against plain Python and SQL."""

import collections
import hashlib
import random

import oracle
import pytest

from quirefold.llm import exact_dedup
from quirefold.llm.queries import QUERIES


def plain(rows):
    """(doc_id, keep_id, size, sha) and how often each kept flag, by grouping normalised texts."""
    groups = collections.defaultdict(list)
    for doc, text in rows:
        content = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups[content].append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for content, members in groups.items():
        members.sort(key=lambda m: m[:3])
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, sha) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect()), key=repr)


def test_equals_sql(spark, sf):
    assert oracle.compare(QUERIES["op13_exact_dedup"](spark, sf), oracle.connect(sf), exact_dedup.SQL) == []


def test_edges(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert got(exact_dedup.report(edge)) == plain(rows)
    assert exact_dedup.report(nothing).collect() == []


@pytest.mark.parametrize("bound", [6_000, 40_000])
def test_buckets_that_outgrow_the_table(spark, bound):
    """Thousands of copies, contents longer than the table, and many small ones, with tables of next to nothing."""
    rng = random.Random(4)
    rows = [(i, "hot copy " * 9 + " " * rng.randrange(4)) for i in range(3_000)]
    rows += [(10_000 + i, f"text {rng.randrange(400)} " * rng.randrange(1, 9)) for i in range(1_500)]
    rows += [(20_000 + i, "long %d " % (i // 2) * 3_000) for i in range(8)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(exact_dedup.report(docs, bucket_bytes=100_000, table_bytes=bound)) == plain(rows)


def test_one_id_in_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "REPEATED", 7)
    rows = [(5, "same")] * 1_000 + [(i, f"other {i}") for i in range(2_000)] + [(4, "sa me")] * 3
    assert got(exact_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_kept_documents_keep_their_columns(spark):
    rows = [(1, "a b", "x", 1), (2, "ab", "y", 2), (3, None, "z", 3), (3, None, "z", 3), (None, "q", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, `a.b` int")
    assert sorted(map(tuple, exact_dedup.deduplicated(docs).collect()), key=repr) == sorted([rows[0], rows[2], rows[4]], key=repr)
    assert exact_dedup.deduplicated(docs).columns == docs.columns
