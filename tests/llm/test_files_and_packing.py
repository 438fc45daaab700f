"""Packing, sharding and token files against plain Python."""

import collections
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quirefold.llm import orc_tokens, packing, sharding
from quirefold.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library(path):
    rng = np.random.default_rng(1)
    letters = list(" \n\t.,'sa$é1A!<|>́字\x1cº")
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(5_000)]
    texts += ["", " ", "<|endoftext|> a <|endoftext|>.b", "don't 'tis", "a  b", "a \n b", "x" * 300, "İstanbul Σας"]
    library, ours = Tokenizer.from_file(path), Encoder(path)
    texts += [" ".join(texts), "plain words, and a line.\nAnother one!"] + ["to be, or not"] * 3
    texts += ["n" + "º" * 100 + "y z", "x'", "a x' b", "a x'b", "º", "a º", "'", "it's", "<|endoftext|>" * 9]
    for _ in range(2):  # the second time from memory
        ids, starts = ours.batch(texts)
        for text, s, e in zip(texts, starts, starts[1:]):
            assert ids[s:e].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_known_words_need_no_library(path):
    """Words met before, in another order, with their marks and apostrophes, do not go through the library again."""
    ours = Encoder(path)
    ours.batch(["x", "Don't stop, it's the dogs' own\nhouse.\nAll right"])

    class Closed:
        def encode_batch_fast(self, texts, **_):
            raise AssertionError(texts)
    library, ours.library = ours.library, Closed()
    text = "x it's right own\nhouse.\nAll the dogs' stop,"
    assert ours.batch([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_with_other_marks_need_no_library(path):
    """A word goes through the library once, whatever marks stand behind it."""
    ours = Encoder(path)
    ours.batch(["x, a the House and, some. élan%%% more.\nelse", "a stop"])
    asked = []

    class Asked:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)
    library, ours.library = ours.library, Asked()
    text = "a the, House. the%%% fresh, fresh. fresh, stop.\nelse it's, a1, stop,"
    assert ours.batch([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    # Known words are not asked for with other marks, a new one once, and one that is not of letters with its marks.
    assert sorted(w for w in asked if w.lower() != w.upper()) == [" a1,", " fresh", " it's,"]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_forgetting_words_keeps_ids(path, monkeypatch):
    from quirefold.llm import tokens
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    library, ours = Tokenizer.from_file(path), Encoder(path)
    for i in range(60):
        texts = [f"the word{i} and word{i + 1}, again the {'long' * 30}{i}.\nEnd of {i} 字", f"word{i // 7} and the end"]
        ids, starts = ours.batch(texts)
        assert len(ours.unsafe) < 70
        for text, s, e in zip(texts, starts, starts[1:]):
            assert ids[s:e].tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_remembered_by_one_encoder():
    library, ours = Tokenizer.from_file(WORD), Encoder(WORD, words=40)
    for i in range(60):
        text = f"the word{i} and word{i + 1}, again {i // 7} and the end"
        assert ours.batch([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(ours.unsafe) < 70


def test_waiting_pieces_do_not_hold_their_batch():
    """Ids of documents read together are let go of, but for the pieces whose windows are still open."""
    batches = []

    def documents():
        for b in range(6):
            ids = np.arange(100 * 1_500)
            batches.append(weakref.ref(ids))
            for i in range(100):
                yield 100 * b + i, ids[1_500 * i : 1_500 * (i + 1)]
            del ids
            assert all(batch() is None for batch in batches[:-1])
    assert sum(len(row[2]) for row in packing.pack_task(documents())) == 6 * 100 * 1_500


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def expected_ids(df, path, end):
    library = Tokenizer.from_file(path)
    return [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [end]) for r in df.collect()]


def test_packing_holds_every_id_once(spark, sf, edge):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(edge.where("doc_id >= 6").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    wanted = dict(expected_ids(docs, WORD, 1))
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(docs, WORD).collect():
        assert r.length == len(r.ids) and r.ids_crc32 == crc(r.ids) and r.doc_tokens == len(wanted[r.doc_id])
        got[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {d: [i for _, ids in sorted(p) for i in ids] for d, p in got.items()} == wanted
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_packing_edges(edge, nothing):
    rows = packing.pack(edge, WORD, with_ids=False).collect()
    assert sum(r.length for r in rows) == sum(len(i) for _, i in expected_ids(edge, WORD, 1))
    assert packing.pack(nothing, WORD).collect() == []


def test_sum_of_squares_choice():
    rng = np.random.default_rng(2)
    packer = packing.Packer(64)
    for length in rng.integers(1, 64, 3_000).tolist():
        before = packer.counts.copy()
        costs = {}
        for level in range(0, 64 - length + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            if level:
                after[level] -= 1
            if level + length < 64:
                after[level + length] += 1
            costs[level] = int((after ** 2).sum())
        packer.place(length)
        assert int((packer.counts ** 2).sum()) == min(costs.values())


def test_pieces_are_powers_of_two():
    for n in (0, 1, 5, 2047, 2048, 5000):
        parts = packing._pieces(n, 2048)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 2048 for p in parts)


def test_shards(spark, sf, edge, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = sharding.sharded(docs).collect()
    wanted = {r.doc_id: (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == wanted and len(got) == len(wanted)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r.law == "rows" and r.grown_shard is None
    assert set(by) == set(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    again = {r.doc_id: (r["shard"], r["slot"]) for r in sharding.sharded(docs.repartition(3)).collect()}
    assert again == {r.doc_id: (r["shard"], r["slot"]) for r in got}  # whatever the partitions
    other = {r.doc_id: (r["shard"], r["slot"]) for r in sharding.sharded(docs, seed=5).collect()}
    assert sum(other[d] == v for d, v in again.items()) < len(again) / 4
    small = sharding.shuffled(edge, 3).collect()
    assert len(small) == 12 and sorted(r.slot for r in small) == sorted([0, 1, 2, 3] * 3)
    assert sharding.sharded(nothing).collect() == []


def test_bucket_beyond_memory_is_shuffled_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BYTES", 2_000)
    docs = spark.createDataFrame([(1, "same text")] * 400 + [(2, "other")], "doc_id long, text string")
    got = sharding.shuffled(docs, 4).collect()
    assert len(got) == 401 and sorted((r.slot, r.shard) for r in got) == sorted((i // 4, i % 4) for i in range(401))


def test_orc_round_trip(spark, sf, edge, nothing, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start, wanted = 0, []
    for doc, ids in sorted(expected_ids(docs, BYTE, 2)):
        wanted.append((doc, start, len(ids), crc(ids)))
        start += len(ids)
    path = str(tmp_path / "t")
    orc_tokens.write(docs, path, BYTE, rows_per_file=40)
    assert len(list((tmp_path / "t").glob("*.orc"))) > 3
    got = orc_tokens.catalogue(spark, path).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == wanted
    one = orc_tokens.read(spark, path).where("doc_id = 17")
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().toString() and len(one.collect()) == 1
    rows = orc_tokens.round_trip(edge, BYTE).collect()
    sizes = sorted(len(i) for _, i in expected_ids(edge, BYTE, 2))
    assert sorted(r.n_tokens for r in rows) == sizes and sorted(r.start for r in rows)[0] == 0
    ends = {r.start + r.n_tokens for r in rows}
    assert {r.start for r in rows} - {0} == ends - {sum(sizes)}
    assert orc_tokens.round_trip(nothing, BYTE).collect() == []
