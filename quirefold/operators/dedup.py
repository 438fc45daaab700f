"""First-wins de-duplication and insert-if-absent.

Keys are digests or ids, so hash partitions are even. Copies of one body may make up a large share
of the rows; every operator here reduces them on the map side before they are shuffled.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, order_cols, hash_col: str = "source_hash") -> DataFrame:
    """Keep the first row of each hash in ``order_cols`` order; rows with an empty hash are all kept.

    Spark plans ``row_number() = 1`` as a group limit before and after the shuffle, so a hash that
    holds a third of all rows sends one row per map task.
    """
    order = [F.col(c) for c in order_cols]
    # An empty hash is no identity: give such rows a key of their own, which also spreads them out.
    own_key = F.concat_ws("/", F.lit("row"), *[c.cast("string") for c in order])
    key = F.when(F.col(hash_col) == "", own_key).otherwise(F.col(hash_col))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def skip_known(df: DataFrame, known: DataFrame, hash_col: str = "source_hash") -> DataFrame:
    """Drop rows whose hash is stored already; an empty hash is never known."""
    stored = known.select(hash_col).where(F.col(hash_col) != "")
    return df.join(stored, hash_col, "left_anti")


def new_rows(incoming: DataFrame, target: DataFrame, keys, order_cols=None) -> DataFrame:
    """Rows of ``incoming`` whose key is absent from ``target``, one per key."""
    keys = list(keys)
    order = [F.col(c) for c in (order_cols or keys)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    single = incoming.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return single.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(incoming: DataFrame, target: DataFrame, keys, order_cols=None) -> DataFrame:
    """Contents of ``target`` after the insert: stored rows stay as they are."""
    return target.unionByName(new_rows(incoming, target, keys, order_cols).select(*target.columns))


def resolve_ids(incoming: DataFrame, stored: DataFrame, hash_col: str = "source_hash",
                id_col: str = "document_id") -> DataFrame:
    """Every incoming row with the stored id of its hash if there is one, else its own.

    ``stored`` has one row per hash, so the join never multiplies rows, and a hash with many
    incoming copies is split over tasks by the adaptive skew join.
    """
    ids = stored.select(hash_col, F.col(id_col).alias("_stored_id"))
    return (incoming.join(ids, hash_col, "left")
            .withColumn(id_col, F.coalesce("_stored_id", id_col)).drop("_stored_id"))


def concat_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of the sources; ``source_ord`` remembers which came first."""
    tagged = [f.withColumn("source_ord", F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for frame in tagged[1:]:
        out = out.unionByName(frame)
    return out


def remove_keys(df: DataFrame, keys: DataFrame, key: str = "document_id") -> DataFrame:
    """Rows whose key is not listed (delete, and its cascade to a child table)."""
    return df.join(keys.select(key).distinct(), key, "left_anti")
