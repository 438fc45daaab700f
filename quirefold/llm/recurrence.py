"""Which hashes recur between units of documents, settled by one shuffle of compressed hash lists.

Units are runs of documents in ascending order of ids. A unit sends every hash once, so a passage that fills a third
of all rows counts once per unit; lists are cut by ranges of hash values, and a reply is one bit per hash sent.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quirefold.llm.common import packed, unpacked

PARCEL = "unit int, bucket int, hashes binary, flags binary, kept binary"
REPLY = "unit int, bucket int, bits binary, kept binary"
_NAMES = [f.split()[0] for f in PARCEL.split(", ")]

#: Flags of a sent hash.
REPEATED, INDEXED = 1, 2


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values ascending, the place of each value among them, the sorting order, and where its groups begin."""
    order = np.argsort(values)
    ascending = values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = ascending[1:] != ascending[:-1]
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ascending[new], place, order, np.flatnonzero(new)


def _edges(distinct: np.ndarray, n_buckets: int, bits: int) -> list[int]:
    """Where each bucket begins among ascending hashes, and the end."""
    width = -(-(1 << bits) // n_buckets)
    cuts = np.array([k * width for k in range(1, n_buckets)], dtype=np.uint64)
    return [0, *np.searchsorted(distinct, cuts).tolist(), len(distinct)]


def parcels(unit: int, distinct: np.ndarray, flags: np.ndarray | None, n_buckets: int, bits: int,
            kept: bytes | None = None) -> pa.Table:
    """The rows a unit sends: its distinct hashes of so many bits, ascending, cut into buckets of equal ranges.

    ``flags`` goes with them: 8-bit flags of each hash, or a 64-bit second hash where the first ones may repeat.
    """
    edges = _edges(distinct, n_buckets, bits)
    rows = []
    for bucket, (s, e) in enumerate(zip(edges, edges[1:])):
        if e > s:
            rows.append((unit, bucket, packed(distinct[s:e]), None if flags is None else packed_flags(flags[s:e]), None))
    if kept is not None:
        rows.append((unit, unit % n_buckets, None, None, kept))
    columns = list(zip(*rows)) or [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=_NAMES)


def packed_flags(flags: np.ndarray) -> bytes:
    if flags.dtype == np.uint64:
        return flags.tobytes()
    return np.packbits(np.stack([flags & REPEATED > 0, flags & INDEXED > 0])).tobytes()


def unpacked_flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=2 * n).reshape(2, n)


def _reply(decide, read=unpacked_flags):
    """Answers to a bucket's parcels. ``decide`` sees all hashes in the order of their units, with what was sent along,
    and gives one or more rows of bits."""
    def run(table: pa.Table) -> pa.Table:
        sent = table.filter(pc.is_valid(table["hashes"]))
        order = np.argsort(sent["unit"].to_numpy(), kind="stable")
        lists, flags = sent["hashes"].to_pylist(), sent["flags"].to_pylist()
        hashes = [unpacked(lists[i], np.uint64) for i in order]
        sizes = [len(h) for h in hashes]
        marks = [read(flags[i], n) for i, n in zip(order, sizes) if flags[i] is not None]
        bits = []
        if hashes:
            answers = np.atleast_2d(decide(np.concatenate(hashes), np.concatenate(marks, axis=-1) if marks else None))
            bits = [np.packbits(a).tobytes() for a in np.split(answers, np.cumsum(sizes)[:-1], axis=1)]
        kept = table.filter(pc.is_valid(table["kept"]))
        return pa.table([
            pa.array([*sent["unit"].to_numpy()[order].tolist(), *kept["unit"].to_pylist()], type=pa.int32()),
            pa.array([*sent["bucket"].to_numpy()[order].tolist(), *kept["bucket"].to_pylist()], type=pa.int32()),
            pa.array([*bits, *[None] * len(kept)], type=pa.binary()),
            pa.array([*[None] * len(bits), *kept["kept"].to_pylist()], type=pa.binary()),
        ], names=["unit", "bucket", "bits", "kept"])
    return run


def _sorted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal hashes together, earlier units first, and where a new hash begins in it."""
    order = np.argsort(hashes, kind="stable")
    ascending = hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return order, new


def _restored(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), dtype=bool)
    out[order] = values
    return out


def _recurring_indexed(hashes, marks):
    order, new = _sorted(hashes)
    starts = np.flatnonzero(new)
    sizes = np.diff([*starts, len(new)])
    yes = (sizes > 1) | (np.maximum.reduceat(marks[0][order], starts) > 0)
    yes &= np.maximum.reduceat(marks[1][order], starts) > 0
    return _restored(order, np.repeat(yes, sizes))


def _earlier(hashes, marks):
    order, new = _sorted(hashes)
    return _restored(order, ~new)


def _earlier_or_mixed(hashes, seconds):
    by_second = np.argsort(seconds, kind="stable")
    order = by_second[np.argsort(hashes[by_second], kind="stable")]
    first, second = hashes[order], seconds[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = first[1:] != first[:-1]
    pair = new.copy()
    pair[1:] |= second[1:] != second[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff([*starts, len(new)])
    mixed = np.repeat(np.add.reduceat(pair, starts, dtype=np.int64) > 1, sizes)
    return np.stack([_restored(order, ~pair), _restored(order, mixed)])


def recurring(sent: DataFrame) -> DataFrame:
    """Bit per hash: it was sent by two units or found repeated by one, and some unit indexed it."""
    return sent.groupBy("bucket").applyInArrow(_reply(_recurring_indexed), REPLY)


def earlier(sent: DataFrame) -> DataFrame:
    """Bit per hash: a unit of a smaller number sent it too."""
    return sent.groupBy("bucket").applyInArrow(_reply(_earlier), REPLY)


def earlier_or_mixed(sent: DataFrame) -> DataFrame:
    """Two bits per pair of hashes: a unit of a smaller number sent it too; its first hash came with several seconds."""
    read = lambda data, n: np.frombuffer(data, dtype=np.uint64)
    return sent.groupBy("bucket").applyInArrow(_reply(_earlier_or_mixed, read), REPLY)


def received(replies: pa.Table, distinct: np.ndarray, n_buckets: int, bits: int, rows: int = 1) -> np.ndarray:
    """The bits of a unit's replies, for the hashes it had sent; as many rows as the reply has."""
    edges = _edges(distinct, n_buckets, bits)
    out = np.zeros((rows, len(distinct)), dtype=bool)
    for bucket, data in zip(replies["bucket"].to_pylist(), replies["bits"].to_pylist()):
        if data is not None:
            s, e = edges[bucket], edges[bucket + 1]
            out[:, s:e] = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=rows * (e - s)).reshape(rows, e - s)
    return out[0] if rows == 1 else out


def kept(replies: pa.Table) -> bytes:
    return next(k for k in replies["kept"].to_pylist() if k is not None)
