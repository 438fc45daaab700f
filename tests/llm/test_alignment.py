"""Alignment of tokenizers against plain Python over whole texts."""

import collections
import hashlib

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quirefold.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """The contract's rows, each text encoded whole and its tokens compared one with another."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    symbols, names = alignment.byte_symbols(), {i: t for t, i in a.get_vocab().items()}

    def spans(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out, b"".join(parts)

    docs, holding = [], collections.Counter()
    for doc, text in rows:
        links, groups = [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spans_a, joined_a = spans([bytes(symbols[c] for c in names[i]) for i in ids_a])
            spans_b, joined_b = spans([bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
                                       b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b])
            if joined_a == joined_b == (" " + text).encode():
                j = 0
                for i, (s, e) in enumerate(spans_a):
                    while j < len(spans_b) and spans_b[j][1] <= s:
                        j += 1
                    k = j
                    while k < len(spans_b) and spans_b[k][0] < e:
                        links.append((ids_a[i], ids_b[k]))
                        k += 1
                cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
                begin = 0
                for cut in cuts:
                    groups.append(([i for i, (s, e) in zip(ids_a, spans_a) if begin <= s and e <= cut],
                                   [i for i, (s, e) in zip(ids_b, spans_b) if begin <= s and e <= cut])
                                  if len(spans_a) < 400 else None)
                    begin = cut
        docs.append((doc, ids_a if links else [], ids_b if links else [], groups, links))
        holding.update(set(links))
    best = collections.Counter()
    for (x, _), n in holding.items():
        best[x] = max(best[x], n)
    out = []
    for doc, ids_a, ids_b, groups, links in docs:
        text = None if None in groups else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(holding[x] == best[x[0]] for x in links),
                    sum(holding[x] for x in links), text and hashlib.sha256(text.encode()).hexdigest()))
    return out


def check(frame, rows):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    found = sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)
    wanted = sorted(plain(rows), key=repr)
    assert len(found) == len(wanted)
    for f, w in zip(found, wanted):
        assert f[:7] == w[:7] and (w[7] is None or f[7] == w[7])


@pytest.mark.parametrize("head", [alignment.HEAD, 50])
def test_equals_whole_texts(spark, sf, head):
    """The given documents; with a small head nearly all pairs are looked up by the join."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    check(alignment.report(docs, A, B, head), [tuple(r) for r in docs.collect()])


def test_edges(spark, edge, nothing):
    texts = [None, "", " ", "  two  spaces  ", "tab\there", "a▁b c", "<|endoftext|> <s> </s>", "naïve 東京 \U0001f600 x", "  nb   sp",
             "x\n y\n\n  z \n", "'s 'tis don't", "\x00 \x1c a", "<0x41> A", "a" * 500, "A A A", "A A A", "\n", "é é ﬁ ½", "a\r\n b", "▁ x"]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "same id"), (3, "same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'u' as pair", "1 as n", "2 as `same`")
    check(alignment.report(docs, A, B), rows)
    assert [tuple(r)[1:] for r in alignment.report(docs.where("doc_id = 5"), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")]
    check(alignment.report(edge, A, B), [(r.doc_id, r.text) for r in edge.collect()])
    assert alignment.report(nothing, A, B).collect() == []


def test_pieces_remembered_or_not(monkeypatch):
    one = alignment.Aligner(A, B)
    texts = ["some words, and some more words", "more  words\nand some"] * 3
    first = one.documents(texts)
    assert {k: v.to_pylist() for k, v in one.documents(texts).items()} == {k: v.to_pylist() for k, v in first.items()}
    monkeypatch.setattr(alignment, "REMEMBERED", 0)
    assert {k: v.to_pylist() for k, v in one.documents(texts).items()} == {k: v.to_pylist() for k, v in first.items()}
