"""Columns that travel along keep their names and values, whatever operators call their own."""

import pytest
from pyspark.sql import functions as F

from quirefold.llm import decontaminate, exact_dedup, pii, quality, sharding, simhash

NAMES = ["score", "row", "mark", "__mark", "found", "__found", "attempts", "bucket", "__bucket", "order", "text2", "a.b", "`q`", "c0",
         "hit_id", "kept_id", "digest", "shard id", "bytes", "spans", "kept", "items"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "write to jane.doe@mail.example now " * 3), (2, None), (3, ""), (4, "one two three four five six seven eight nine ten eleven"),
            (5, "wholly other words stand here and nobody minds them"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for name in NAMES:
        frame = frame.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return frame.withColumn("nested", F.struct(F.col("doc_id").alias("x.y"), F.array(F.lit(1)).alias("list")))


OPERATORS = {
    "quality": lambda d, s: quality.kept(d, s.createDataFrame([(4, 1), (5, 0)], "doc_id long, quality int"), 0.0),
    "simhash": lambda d, s: simhash.representatives(d),
    "decontaminate": lambda d, s: decontaminate.decontaminate(d, s.createDataFrame([(1, "one two three four five six seven eight nine ten")],
                                                                                  "item_id long, text string")),
    "spans": lambda d, s: decontaminate.decontaminate(d, s.createDataFrame([(1, "one two three four five six seven eight nine ten")],
                                                                          "item_id long, text string"), "spans"),
    "pii": lambda d, s: pii.surrogated(d, "key"),
    "sharding": lambda d, s: sharding.shuffled(d, 3),
    "exact": lambda d, s: exact_dedup.deduplicated(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_columns_travel(spark, docs, name):
    out = OPERATORS[name](docs, spark)
    added = {"pii": ["pii_kinds"], "sharding": ["shard", "slot"]}.get(name, [])
    assert out.columns == docs.columns + added
    rows = out.collect()
    assert rows
    for r in rows:
        for i, column in enumerate(docs.columns):
            if column in NAMES:
                assert r[i] == f"{column} of {'none' if r[0] is None else r[0]}"
    assert {r[0] for r in rows} >= ({1, 5, None} if name != "simhash" else {1, 5})


def test_names_that_differ_in_case_only(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs = spark.createDataFrame([(1, "lower", "UPPER"), (2, "more", "MORE")], "doc_id long, text string, TEXT string")
        for name, run in OPERATORS.items():
            out = run(docs, spark)
            assert out.columns[:3] == ["doc_id", "text", "TEXT"], name
            assert {(r[0], r[2]) for r in out.collect()} <= {(1, "UPPER"), (2, "MORE")}, name
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_one_id_in_all_rows_is_one_row_of_the_sample(spark):
    """Labelled rows under one id are reduced to one before they are gathered."""
    docs = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 50).cast("string")).alias("text"))
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    taken = []
    fit, quality.fit = quality.fit, lambda texts, wanted: taken.append((texts, wanted))
    try:
        quality.trained(docs, labels)
    finally:
        quality.fit = fit
    assert len(taken[0][0]) == 1 and taken[0][1] == [1]


def test_a_set_too_large_to_broadcast(spark, sf):
    """Whole documents against items cut from them: both ways of joining give the same rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").cast("string"), "text").unionByName(
        docs.select(F.concat(F.lit("d"), "doc_id").alias("item_id"), F.substring("text", 40, 400).alias("text")).where("item_id like '%7'"))
    a, b = (sorted(map(str, decontaminate.scan(docs, benchmark, broadcast_bytes=n).collect())) for n in (64 << 20, 0))
    assert a == b and len(a) == docs.count()


def test_spans_and_edges_of_decontamination(spark, edge, nothing):
    """Null, empty, long and repeated texts, removed spans, and the benchmark set joined by shuffling."""
    benchmark = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (None, "w5 und w6 und"), (3, "")], "item_id long, text string")
    held = [sorted(map(str, decontaminate.scan(edge, benchmark, carry=("doc_id",), broadcast_bytes=b).collect())) for b in (1 << 20, 0)]
    assert held[0] == held[1] and len(held[0]) == edge.count()
    plan = decontaminate.scan(edge, benchmark, broadcast_bytes=0)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    hit = {r.kept.doc_id for r in decontaminate.scan(edge, benchmark).where("size(spans) > 0").collect()}
    assert {3, 4} <= hit and not hit & {1, 2, 5, 6, 7, None}
    left = decontaminate.decontaminate(edge, benchmark)
    assert left.columns == edge.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in edge.collect()} - hit
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(edge, benchmark, "spans").collect()}
    assert cut[3] == cut[4] == "" and cut[1] is None and cut[6] == "x"
    assert decontaminate.decontaminate(nothing, benchmark).collect() == []
    assert decontaminate.decontaminate(edge, benchmark.limit(0)).count() == edge.count()
