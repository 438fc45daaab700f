"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned by every word window of the documents.

Native DataFrame functions only. Every window of a document becomes one 64-bit hash that is looked up in the set of
test windows; a hit is verified on the words themselves. The set is broadcast while it is smaller than a stated
number of bytes. Beyond that, places and hashes alone are shuffled to it, and what is found there goes back to the texts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import carried, checkpointed

WINDOW = 10
#: Largest set of test windows that is broadcast, in bytes of their texts and item lists.
BROADCAST_BYTES = 64 << 20

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = 0  # pretended hash of the one entry per document that always matches


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else unchanged.

    ``lower`` is much faster than ``translate`` and does the same where no other character has a lower case.
    """
    other = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(other == F.lower(other), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and all other characters beyond ASCII (splitting is much faster than extracting)."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _windows(hashes: Column, n: Column, length: int) -> Column:
    """Hashes of the windows of one length, over the hashes of their words (single gets are faster than slices)."""
    starts = F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram_hash(words: Column, window: int) -> Column:
    """The hash that ``_windows`` gives to these words: each length has its own branch."""
    out = F.lit(None).cast("long")
    for length in range(1, window + 1):
        out = F.when(F.size(words) == length, F.element_at(_windows(_hashes(words), F.size(words), length), 1)).otherwise(out)
    return out


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: ``h, gram, size`` and ``items``, the ids as strings.

    An item of fewer words than a window, but not none, is one window. Null ids are left out of the lists.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    n = F.size("words")
    size = F.least(F.lit(window), n)
    grams = (items.where(n > 0)
             .select("item", F.explode(F.transform(F.sequence(F.lit(1), n - size + 1),
                                                   lambda i: F.slice("words", i, size))).alias("gram_words")))
    return (grams.groupBy("gram_words").agg(F.collect_set("item").alias("items"))
            .select(_gram_hash(F.col("gram_words"), window).alias("h"),
                    F.array_join("gram_words", " ").alias("gram"), F.size("gram_words").alias("size"), "items"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ("doc_id",),
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hits of every document: ``kept``, a struct of the carried columns, with ``n_words, spans, items``.

    ``spans`` are the merged runs of hit words as (start, end) in words, ``items`` the sorted ids of the items that
    have an occurring window. One row per input row, repeated rows and null ids included; a null or empty text has no
    words; an empty benchmark hits nothing.
    """
    grams = test_windows(benchmark, window)
    facts = grams.agg(F.collect_set("size"), F.sum(F.octet_length("gram") + 16 * F.size("items") + 16)).first()
    lengths, weight = sorted(facts[0]), facts[1] or 0
    if weight > broadcast_bytes:
        return _scan_by_shuffle(docs, grams, lengths, carry)
    every = grams.sparkSession.range(1).select(F.lit(_ROW).cast("long").alias("h"), F.lit("").alias("gram"),
                                               F.lit(0).alias("size"), F.array().cast("array<string>").alias("items"))
    table = F.broadcast(grams.unionByName(every))

    kept = F.struct(*[F.col(c) for c in carry])
    rows = (docs.select(kept.alias("kept"), words_of(F.col("text")).alias("words"))
            .withColumn("row", F.monotonically_increasing_id()))
    n = F.size("words")
    # The one-element array binds the hashes to a name: without it they are worked out again for every window.
    entries = F.flatten(F.transform(F.array(_hashes(F.col("words"))), lambda hashes: F.concat(
        F.array(F.lit(_ROW).cast("long")), *[_windows(hashes, n, length) for length in lengths])))
    probes = rows.select("row", "kept", "words", F.posexplode(entries).alias("at", "h"))
    pos, length = _place(F.col("at"), n, lengths, 1)  # entry 0 stands for the row
    same = F.when(pos < 0, F.col("size") == 0).otherwise(
        (length == F.col("size")) & (F.array_join(F.slice("words", F.greatest(pos, F.lit(0)) + 1, length), " ") == F.col("gram")))
    hits = probes.join(table, "h").where(same).select(
        "row", F.when(pos < 0, F.col("kept")).alias("kept"), F.when(pos < 0, length).alias("n_words"),
        F.when(pos >= 0, F.struct(pos.alias("pos"), (pos + length).alias("end"))).alias("span"),
        F.when(pos >= 0, F.col("items")).alias("items"))
    found = hits.groupBy("row").agg(F.first("kept", ignorenulls=True).alias("kept"), F.max("n_words").alias("n_words"),
                                    F.array_sort(F.collect_list("span")).alias("spans"),
                                    F.collect_set("items").alias("items"))
    return found.select("kept", "n_words", _merged(F.col("spans")).alias("spans"),
                        F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def _place(at: Column, n: Column, lengths: list[int], first: int) -> tuple[Column, Column]:
    """Position and length of the window behind an entry: from entry ``first`` on come the windows of each length."""
    pos, length, start = F.lit(-1), n, F.lit(first)
    for size in lengths:
        pos, length = F.when(at >= start, at - start).otherwise(pos), F.when(at >= start, F.lit(size)).otherwise(length)
        start = start + F.greatest(n - size + 1, F.lit(0))
    return pos, length


def _scan_by_shuffle(docs: DataFrame, grams: DataFrame, lengths: list[int], carry: tuple[str, ...]) -> DataFrame:
    """``scan`` for a set that is too large to be broadcast.

    A window travels as its place and two hashes, of the text and of the window. Windows whose hash is in the set are
    gathered by text, equal texts once, written down, and joined back to the documents, where they are verified on the
    words. A hash that two texts or two windows share thus costs a comparison and changes nothing.
    """
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark")
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("kept"), words_of(F.col("text")).alias("words"), mark)
    entries = F.flatten(F.transform(F.array(_hashes(F.col("words"))), lambda hashes: F.concat(
        *[_windows(hashes, F.size("words"), length) for length in lengths])))
    probes = rows.select("mark", F.size("words").alias("n"), F.posexplode(entries).alias("at", "h"))
    pos, length = _place(F.col("at"), F.col("n"), lengths, 0)
    probes = probes.select("mark", "h", pos.alias("pos"), length.alias("size"))
    found = (probes.join(grams, ["h", "size"])
             .groupBy("mark").agg(F.collect_set(F.struct("pos", (F.col("pos") + F.col("size")).alias("end"), "gram", "items")).alias("hits")))
    same = F.filter("hits", lambda x: F.array_join(F.slice("words", x["pos"] + 1, x["end"] - x["pos"]), " ") == x["gram"])
    hits = rows.join(checkpointed(found), "mark", "left").select("kept", F.size("words").alias("n_words"), F.coalesce(
        same, F.array().cast("array<struct<pos:int,end:int,gram:string,items:array<string>>>")).alias("hits"))
    spans = F.array_sort(F.transform("hits", lambda x: F.struct(x["pos"].alias("pos"), x["end"].alias("end"))))
    return hits.select("kept", "n_words", _merged(spans).alias("spans"),
                       F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"])))).alias("items"))


def _merged(spans: Column) -> Column:
    """Overlapping or touching spans, sorted by start, as disjoint ones: a span that starts after all before it ended
    opens a run, and a run ends where the next one opens."""
    struct = "array<struct<pos:int,end:int>>"
    return F.aggregate(
        spans, F.struct(F.array().cast(struct).alias("done"), F.lit(-1).alias("pos"), F.lit(-1).alias("end")),
        lambda a, x: F.when(x["pos"] > a["end"], F.struct(
            F.when(a["end"] >= 0, F.concat(a["done"], F.array(F.struct(a["pos"].alias("pos"), a["end"].alias("end")))))
            .otherwise(a["done"]).alias("done"), x["pos"].alias("pos"), x["end"].alias("end")))
        .otherwise(F.struct(a["done"].alias("done"), a["pos"].alias("pos"),
                            F.greatest(a["end"], x["end"]).alias("end"))),
        lambda a: F.when(a["end"] >= 0, F.concat(
            a["done"], F.array(F.struct(a["pos"].alias("pos"), a["end"].alias("end"))))).otherwise(a["done"]))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its hit words and what stands before each of them; null stays null."""
    words = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    gaps = F.split(text, ANY_CASE_WORD, -1)
    tokens = F.zip_with(F.slice(gaps, 1, F.size(words)), words, lambda g, w: F.concat(g, w))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["pos"]), F.array(F.size(words)))
    kept = F.flatten(F.zip_with(ends, starts, lambda e, s: F.slice(tokens, e + 1, s - e)))
    return F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without contaminated ones (``documents``) or without the hit words (``spans``).

    Documents without a hit stay exactly as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is documents or spans, not {remove!r}")
    every = carried(docs, "doc_id", "text")
    if remove == "spans":
        found = scan(every.rows, benchmark, window, carry=("row", "text")).select("kept.row", "kept.text", "spans")
        text = F.when(F.size("spans") > 0, without_spans(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
        return every.back(found, text=text)
    keyed = every.rows.withColumn("mark", F.xxhash64("text"))
    hit = (scan(keyed, benchmark, window, carry=("doc_id", "mark")).where(F.size("spans") > 0)
           .select(F.col("kept.doc_id").alias("hit_id"), F.col("kept.mark").alias("hit_mark")).distinct())
    return every.back(keyed.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("mark") == F.col("hit_mark")), "left_anti"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document with what was hit; see the contract of the query."""
    found = scan(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["pos"]))
    return found.select(
        F.col("kept.doc_id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, k, s, array_to_string(w[s : s + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT r, s, k, item_id FROM dw JOIN bw USING (k, gram)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)"""
