"""Each stage of the pipeline against a brute-force version on its own input."""

import collections

import corpus_pipeline
import numpy as np
import oracle
from pyspark.sql import functions as F
from test_simhash import expected as brute_simhash
from tokenizers import Tokenizer

from quirefold.llm import decontaminate, quality


def test_stages(spark, sf, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii_surrogates", "sequence_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    columns, inputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns or name == "sequence_packing"
    raw, good, single, clean, surrogates = inputs

    network = quality.trained(raw, labels)
    texts = {r.doc_id: r.text for r in raw.collect()}
    kept = {i for i, t in texts.items() if network.scores([t.encode()])[0] >= 0.3}
    assert {r.doc_id for r in good.collect()} == kept

    wanted = {c for _, _, c in brute_simhash([(i, texts[i]) for i in kept])}
    assert {r.doc_id for r in single.collect()} == wanted

    con = oracle.connect(sf)
    hit = {r[0] for r in con.sql(decontaminate.SQL).fetchall() if r[5]}
    assert {r.doc_id for r in clean.collect()} == wanted - hit

    rows = {r.doc_id: r for r in surrogates.collect()}
    assert set(rows) == wanted - hit and all(r.n_chars == len(r.text) for r in rows.values())
    assert all(r.lang is not None and r.source is not None for r in rows.values())

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    got = collections.defaultdict(list)
    for r in docs.collect():
        got[r.doc_id].append((r.start, r.ids))
    assert {i: [x for _, p in sorted(p) for x in p] for i, p in got.items()} == {
        i: library.encode(r.text, add_special_tokens=False).ids + [1] for i, r in rows.items()}
    again = corpus_pipeline.run(spark, sf)
    assert again.columns == docs.columns and again.agg(F.sum("length")).first() == docs.agg(F.sum("length")).first()
    assert np.all([r.length > 0 for r in again.collect()])


def test_stages_on_edges(spark, edge, nothing, sf):
    for frame in (edge, nothing):
        docs = frame.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                            F.length("text").cast("long").alias("n_chars"), F.lit(1).alias("unit"))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            assert out.count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= frame.count()
