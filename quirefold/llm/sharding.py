"""Sharding by a two-pass external shuffle.

Pass one scatters the rows by a seeded hash into buckets of about a memory's size; pass two shuffles every bucket in
memory (Fisher-Yates, seeded per bucket) and writes it. Between the two, only one row count per bucket is gathered:
it says at which place of the whole order a bucket begins, so shards get row counts that differ by one at most.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold.llm.common import carried, text_bytes
from quirefold.sources.shared import shared_path

BUCKET_BYTES = 8 << 20
#: Fewest buckets, so that a small table still spreads over the tasks.
LEAST_BUCKETS = 64
#: Rows of one bucket that are shuffled at once; only a bucket of repeated rows can hold more than a memory's size.
BLOCK_BYTES = 64 << 20


def _bucket(seed: int, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(n)).cast("int")


def shuffled(docs: DataFrame, n_shards: int = 16, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns with ``shard`` and ``slot``, in one seeded random order cut into equal shards.

    Row r of the whole order has shard r mod n and slot r div n: counts differ by one at most and slots have no gaps.
    The order depends on the rows and the seed only, not on files or partitions. Rows of equal id and text share a
    bucket, which is shuffled block by block should they be very many. Null ids and texts are values like any other.
    """
    every = carried(docs.drop("shard", "slot"), "doc_id", "text")  # of an earlier run
    n = max(LEAST_BUCKETS, -(-text_bytes(every.rows) // bucket_bytes))
    scattered = every.rows.select("row", _bucket(seed, n).alias("bucket"),
                                  F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("text")).alias("order"))
    counts = {r[0]: r[1] for r in scattered.groupBy("bucket").count().collect()}  # one row per bucket
    begins = np.zeros(n + 1, dtype=np.int64)
    np.cumsum([counts.get(b, 0) for b in range(n)], out=begins[1:])
    schema = T.StructType([scattered.schema["row"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def finish(bucket: int, block: int, at: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).select(["row"]).combine_chunks()
        order = np.random.default_rng([seed, bucket, block]).permutation(table.num_rows)  # Fisher-Yates
        rank = begins[bucket] + at + np.arange(table.num_rows)
        out = table.take(pa.array(order)).append_column("shard", pa.array((rank % n_shards).astype(np.int32)))
        return out.append_column("slot", pa.array(rank // n_shards))

    def shuffle(batches):
        bucket, block, at, held, size = None, 0, 0, [], 0
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("bucket")).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)] if len(ids) else [0]
            for s, e in zip(edges, edges[1:]):
                if held and (ids[s] != bucket or size > BLOCK_BYTES):
                    yield from finish(bucket, block, at, held).to_batches()
                    same = ids[s] == bucket
                    block, at = (block + 1, at + sum(b.num_rows for b in held)) if same else (0, 0)
                    held, size = [], 0
                bucket = int(ids[s])
                held.append(batch.slice(s, e - s))
                size += batch.nbytes * (e - s) // max(1, batch.num_rows)
        if held:
            yield from finish(bucket, block, at, held).to_batches()

    placed = (scattered.repartitionById(n, "bucket").sortWithinPartitions("bucket", "order")
              .drop("order").mapInArrow(shuffle, schema))
    return every.back(placed, shard=F.col("shard"), slot=F.col("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, seed: int = 0) -> None:
    """Write the shuffled rows as Parquet, a folder per shard; files of a shard hold runs of its slots."""
    shuffled(docs, n_shards, seed).write.partitionBy("shard").option("compression", "zstd").parquet(path)


def sharded(docs: DataFrame, n_shards: int = 16, seed: int = 0) -> DataFrame:
    """The contract's row per document, from the written shards."""
    docs = docs.select("doc_id", "text")
    path = shared_path(docs.sparkSession, "shards")
    write_shards(docs, path, n_shards, seed)
    text = F.coalesce("text", F.lit(""))
    written = docs.sparkSession.read.schema(T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()),
                                                          T.StructField("slot", T.LongType())])).parquet(path)
    return written.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
