"""Exact deduplication by a Grace hash: records are partitioned until each bucket fits a table of complete contents.

Two texts are equal when nothing differs but white space. Records (content, copies, row that stays) are dealt out by a
hash of their digest into buckets. A bucket is read into an open-addressing table that compares contents in full
(Python's dict is one). A bucket that outgrows the table's bound is written to spill files, already merged
as far as the table went, and dealt out again with another seed. A bucket of many different contents is so cut into
finer ones, and one of many copies shrinks with each merging, so no task holds more than the bound and one record.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.llm.common import carried, text_bytes
from quirefold.sources.shared import shared_path

#: Content bytes that a bucket is planned for, and that a table may hold before its bucket is partitioned further.
BUCKET_BYTES, TABLE_BYTES = 16 << 20, 64 << 20
#: What an entry of the table takes besides its content.
ENTRY_BYTES = 300
#: Fewest buckets, so that a small table still spreads over the tasks.
LEAST_BUCKETS = 16
#: Repeated rows (equal id, length and content) that are handed out together.
REPEATED = 100_000

WHITE = b" \t\n\x0b\x0c\r"
RECORD = "digest binary, content binary, copies long, n_chars long, doc_id long, settled boolean"
_NAMES = [f.split()[0] for f in RECORD.split(", ")]

SQL = r"""
WITH normalised AS (
  SELECT doc_id, coalesce(text, '') AS original, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(content) AS text_sha256
FROM normalised WINDOW w AS (PARTITION BY content ORDER BY length(original) DESC, doc_id NULLS LAST)"""


def normalised(text: bytes | None) -> bytes:
    """What is compared: the text without white space; null is empty."""
    return (text or b"").translate(None, WHITE)


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(normalised(t)).digest() for t in texts.to_pylist()], type=pa.binary())
    return run(text.cast("binary"))


def _stays(a: tuple, b: tuple) -> tuple:
    """Of two rows (code points, id) the one that stays: more code points, then the smaller id, null ids last."""
    return min(a, b, key=lambda r: (-r[0], r[1] is None, r[1] or 0))


class Table:
    """Distinct contents with their copies and the row that stays."""

    def __init__(self):
        self.entries: dict[bytes, tuple[int, tuple]] = {}
        self.size = 0

    def add(self, content: bytes, copies: int, row: tuple) -> None:
        held = self.entries.get(content)
        if held is None:
            self.entries[content] = (copies, row)
            self.size += len(content) + ENTRY_BYTES
        else:
            self.entries[content] = (held[0] + copies, _stays(held[1], row))

    def records(self, settled: bool) -> pa.RecordBatch:
        """Its rows and an empty table again; settled ones leave their content behind."""
        digests = [hashlib.sha256(c).digest() for c in self.entries]
        if len(set(digests)) < len(digests):
            raise ValueError("two contents have one SHA-256 digest")
        copies, rows = zip(*self.entries.values()) if self.entries else ((), ())
        columns = [digests, [None] * len(digests) if settled else list(self.entries), copies,
                   [r[0] for r in rows], [r[1] for r in rows], [settled] * len(digests)]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        out = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=_NAMES)
        self.entries, self.size = {}, 0
        return out

    def full(self, bound: int) -> bool:
        return self.size > bound and len(self.entries) > 1


def _merged(bound: int):
    """Records of a task's documents, equal ones merged; the table is handed on whenever it is full."""
    def run(batches):
        table = Table()
        for batch in batches:
            for doc_id, n_chars, text in zip(*(c.to_pylist() for c in batch.columns)):
                table.add(normalised(text), 1, (n_chars, doc_id))
                if table.full(bound):
                    yield table.records(False)
        if table.entries:
            yield table.records(False)
    return run


def _settled(bound: int):
    """Classes of a bucket that fits the table; of one that does not, its records for the next partitioning."""
    def run(batches):
        table, whole = Table(), True
        for batch in batches:
            _, contents, copies, n_chars, ids, _ = (c.to_pylist() for c in batch.columns)
            for content, n, row in zip(contents, copies, zip(n_chars, ids)):
                table.add(content, n, row)
                if table.full(bound):
                    whole = False
                    yield table.records(False)
        if table.entries:
            yield table.records(whole)
    return run


def classes(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: ``digest``, ``copies``, and ``n_chars`` and ``doc_id`` of the row that stays."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                        F.col("text").cast("binary").alias("text"))
    records = texts.mapInArrow(_merged(bucket_bytes), RECORD)
    size, level, found = text_bytes(docs), 0, []
    while True:
        n = max(LEAST_BUCKETS, -(-size // bucket_bytes)) << level  # finer each time, so that partitioning ends
        bucket = F.pmod(F.xxhash64(F.lit(level), "digest"), F.lit(n)).cast("int")
        path = shared_path(spark, f"grace-{level}")
        (records.withColumn("bucket", bucket).repartitionById(n, "bucket").drop("bucket")
         .mapInArrow(_settled(table_bytes), RECORD).write.partitionBy("settled").parquet(path))
        stored = spark.read.schema(RECORD).parquet(path)
        found.append(stored.where("settled").drop("content", "settled"))
        records = stored.where("not settled")
        size = records.agg(F.sum(F.octet_length("content"))).first()[0]
        if size is None:
            break
        level += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def report(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The contract's row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text is empty, and empty texts are copies of each other. A null id loses against any other. Rows of equal id,
    code points and content count one by one, and one of them is kept if any is. An empty table gives no rows; other
    columns are not read. The documents of a class meet in a join, which adaptive execution splits where a class is large.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                       digest(F.col("text")).alias("digest"))
    members = rows.groupBy("digest", "doc_id", "n_chars").agg(F.count("*").alias("repeats"))
    shared = classes(docs, bucket_bytes, table_bytes).where("copies > 1").select(
        "digest", "copies", F.col("doc_id").alias("keep_id"), F.col("n_chars").alias("keep_chars"))
    joined = members.join(shared, "digest", "left")
    stays = F.col("copies").isNull() | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")))
    blocks = joined.withColumn("kept", stays).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.expr(f"(repeats - 1) div {REPEATED}").cast("int"))))
    first = F.col("block").cast("long") * REPEATED + 1
    each = blocks.hint("rebalance").withColumn(
        "number", F.explode(F.sequence(first, F.least("repeats", first + (REPEATED - 1)))))
    return each.select("doc_id", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
                       (F.col("kept") & (F.col("number") == 1)).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names; of repeated rows any one."""
    every = carried(docs, "doc_id", "text")
    rows = every.rows.select("row", F.col("doc_id").cast("long").alias("id"),
                             F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), digest(F.col("text")).alias("digest"))
    kept = classes(every.rows).select("digest", F.col("doc_id").alias("keep_id"), "n_chars")
    winners = rows.join(kept, "digest").where(F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("n_chars")))
    return every.back(winners.groupBy("digest").agg(F.first("row").alias("row")))
