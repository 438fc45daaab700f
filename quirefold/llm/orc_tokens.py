"""Token ids in ORC: integer run lengths, row indexes and Bloom filters on document ids.

Documents are laid out in ranges of ascending ids and encoded where they lie, so files, stripes and row groups hold
disjoint ranges of ids. A reader takes stripes in parallel, and the row index and the Bloom filters let it skip
whatever cannot hold a wanted document.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirefold.llm import tokens
from quirefold.llm.common import checkpointed
from quirefold.sources.shared import shared_path

STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1_000
ROWS_PER_FILE = 2_500
END = 2
SCHEMA = "doc_id long, ids array<int>"


def _encoded(path: str, end: int):
    def run(batches):
        encode = tokens.encoder(path)
        for batch in batches:
            ids, starts = encode.batch([t or "" for t in batch.column(1).to_pylist()])
            values = np.insert(ids, starts[1:], end).astype(np.int32)
            offsets = (starts + np.arange(len(starts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, rows_per_file: int = ROWS_PER_FILE,
          stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write ``doc_id, ids`` in ascending order of ids; a null text is empty and holds the end id only."""
    n = max(1, -(-docs.count() // rows_per_file))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    (ordered.mapInArrow(_encoded(tokenizer, end), SCHEMA).write
     .option("compression", "snappy").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", ROWS_PER_INDEX).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on ``doc_id`` is pushed into the reader, which prunes by statistics and filters."""
    return spark.read.schema(SCHEMA).orc(path)


def _digests(batches):
    for batch in batches:
        lists = batch.column(1)
        values = np.asarray(lists.flatten(), dtype="<u4")
        sizes = np.diff(np.asarray(lists.offsets))
        ends = np.cumsum(sizes)
        crcs = [tokens.crc32(values[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes.astype(np.int64)),
                                          pa.array(crcs, type=pa.int64())],
                                         names=["doc_id", "file", "n_tokens", "ids_crc32"])


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document, from the files: where its ids start in the whole, how many they are, and their CRC.

    Running sums are taken within each file, whose ids form one range; files before it add their totals. Rows of one
    id lie in one file and are ordered by their ids' count and CRC; null ids come first.
    """
    stored = checkpointed(read(spark, path).withColumn("file", F.col("_metadata.file_name"))
                          .mapInArrow(_digests, "doc_id long, file string, n_tokens long, ids_crc32 long"))  # read once
    rows = Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32")
    within = stored.withColumn("inside", F.sum("n_tokens").over(rows.rowsBetween(Window.unboundedPreceding, -1)))
    # One row per file: few enough for one task.
    totals = stored.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first"),
                                        F.max(F.col("doc_id").isNull()).alias("nulls"))
    files = Window.orderBy(F.col("nulls").desc(), "first", "file")
    before = totals.select("file", F.coalesce(F.sum("total").over(
        files.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return within.join(before, "file").select(
        "doc_id", (F.col("before") + F.coalesce("inside", F.lit(0))).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    path = shared_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, end)
    return catalogue(docs.sparkSession, path)
