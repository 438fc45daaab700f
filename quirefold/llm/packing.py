"""Sum-of-squares online packing of token sequences.

Every task packs the documents it reads, one by one. A document longer than a window fills whole windows first; what
is left goes to the fill level whose choice makes the sum of squared counts of partially filled windows smallest. The
counts stand in an array by level. Windows still partially filled when the task's documents end are emptied again and
their pieces laid end to end over new windows, the last of which have powers of two as lengths, so nothing is padded.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.llm import tokens

WINDOW = 2048
END = 1
#: Documents whose ids are in memory at one time, besides the pieces in windows that are still open.
DOCUMENTS = 1_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids array<int>")
#: Sequence numbers of one task; a task's partition number stands above them.
PER_TASK = 1 << 40


class Packer:
    """Windows of one task. ``counts[h]`` open windows are filled to level h; ``open[h]`` are their numbers."""

    def __init__(self, size: int = WINDOW):
        self.size, self.counts = size, np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.held: dict[int, list] = {}
        self.last = -1

    def new(self) -> int:
        self.last += 1
        return self.last

    def place(self, length: int) -> tuple[int, int]:
        """Window and level for a piece shorter than a window, by the least change of the sum of squares.

        Moving a window from level h to h + length changes the sum by 2 (N(h + length) - N(h) + 1); full windows and
        empty ones are not counted. Ties go to the highest level.
        """
        n, top = self.counts, self.size - length
        change = 2 * (n[length:] - n[: top + 1] + 1)
        change[0] = 2 * n[length] + 1
        change[top] = 1 - 2 * n[top] if top else change[top]
        allowed = n[: top + 1] > 0
        allowed[0] = True
        change[~allowed] = np.iinfo(np.int64).max
        level = top - int(np.argmin(change[::-1]))
        window = self.open[level].pop() if level else self.new()
        if level:
            n[level] -= 1
        if level + length < self.size:
            n[level + length] += 1
            self.open[level + length].append(window)
        return window, level


def _pieces(length: int, size: int) -> list[int]:
    """Whole windows, then the powers of two that sum up to the rest, longest first."""
    return [size] * (length // size) + [1 << b for b in reversed(range(size.bit_length())) if length % size >> b & 1]


def pack_task(documents, size: int = WINDOW):
    """Rows (document, start, ids, doc_tokens, window, offset) for an iterator of (document, ids)."""
    packer = Packer(size)
    for doc, ids in documents:
        total = len(ids)
        whole = total - total % size
        for at in range(0, whole, size):
            yield doc, at, ids[at : at + size], total, packer.new(), 0
        if whole == total:
            continue
        piece = (doc, whole, ids[whole:].copy(), total)  # waits in its window without the ids that it was cut from
        window, level = packer.place(total - whole)
        packer.held.setdefault(window, []).append((piece, level))
        if level + total - whole == size:
            for held, offset in packer.held.pop(window):
                yield *held, window, offset
    rest = [held for window in sorted(packer.held) for held, _ in packer.held[window]]
    lengths = iter(_pieces(sum(len(r[2]) for r in rest), size))
    window, room, offset = -1, 0, 0
    for doc, start, ids, total in rest:
        while len(ids):
            if not room:
                room, window, offset = next(lengths), packer.new(), 0
            part = ids[:room]
            yield doc, start, part, total, window, offset
            start, ids, room, offset = start + len(part), ids[len(part) :], room - len(part), offset + len(part)


def _packed(path: str, end: int, size: int, with_ids: bool, characters: int, words: int | None):
    def run(batches):
        base = TaskContext.get().partitionId() * PER_TASK
        encode = tokens.encoder(path, words)

        def documents():
            for batch in (b.slice(at, DOCUMENTS) for b in batches for at in range(0, b.num_rows, DOCUMENTS)):
                ids, starts = encode.batch([t or "" for t in batch.column(1).to_pylist()], characters)
                ids = np.insert(ids, starts[1:], end)
                starts = (starts + np.arange(len(starts))).tolist()
                for doc, s, e in zip(batch.column(0).to_pylist(), starts, starts[1:]):
                    yield doc, ids[s:e]

        def rows(held):
            doc, start, ids, total, window, offset = zip(*held)
            lists = pa.array([i.astype(np.int32) if with_ids else None for i in ids], type=pa.list_(pa.int32()))
            columns = [pa.array(doc, type=pa.int64()), start, [len(i) for i in ids],
                       [tokens.crc32(i) for i in ids], total, [base + w for w in window], offset]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=pa.int64()) for c in columns]
                                              + [lists], names=[f.split()[0] for f in SCHEMA.split(", ")])

        held = []
        for row in pack_task(documents(), size):
            held.append(row)
            if len(held) == 2_000:
                yield rows(held)
                held = []
        if held:
            yield rows(held)
    return run


def pack(docs: DataFrame, tokenizer: str, size: int = WINDOW, end: int = END, with_ids: bool = True,
         characters: int = tokens.CHARACTERS, words: int | None = None) -> DataFrame:
    """Pieces of all documents (null text: empty, so the end id alone) with their sequences; columns as in SCHEMA.

    ``characters`` of texts are encoded together in memory, and every Python worker remembers so many ``words``. Needs no shuffle: every task packs what it reads, and its sequences have numbers of their own.
    """
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_packed(tokenizer, end, size, with_ids, characters, words), SCHEMA)
    return out if with_ids else out.drop("ids")
