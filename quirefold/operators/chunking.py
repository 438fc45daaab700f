"""Splitting texts into overlapping, token-bounded chunks."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv
from quirefold.functions.hashing import content_hash
from quirefold.functions.text import has_text, text_by_text, token_estimate
from quirefold.operators.select import within_bytes

SEPARATORS = ("\n\n", "\n", " ")
STRATEGIES = ("recursive", "window")


def estimate_tokens(text: str) -> int:
    return max(1, len(text) // 4)


class TokenLength:
    """Length in tokens of a tokenizer file, for the tokenizers library.

    A text is encoded once; a span of it counts the tokens that begin in it, one at least. At blanks, where no token lies
    across, that is the length of the span encoded alone.
    """

    def __init__(self, path: str):
        self.path = path
        self._tokenizer = None

    def __getstate__(self):
        return {"path": self.path, "_tokenizer": None}

    def _offsets(self, text: str) -> list[tuple[int, int]]:
        if self._tokenizer is None:
            from tokenizers import Tokenizer
            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer.encode(text, add_special_tokens=False).offsets

    def __call__(self, text: str) -> int:
        return max(1, len(self._offsets(text)))

    def spans(self, text: str) -> Callable[[int, int], int]:
        begins = np.fromiter((s for s, _ in self._offsets(text)), dtype=np.int64)
        before = np.searchsorted(begins, np.arange(len(text) + 1)).tolist()  # tokens that begin before each place
        return lambda start, end: max(1, before[end] - before[start])


def _measure(text: str, length) -> Callable[[int, int], int]:
    """Length of a span of the text; without cutting it out where the length function can tell."""
    if length is estimate_tokens:
        return lambda start, end: max(1, (end - start) // 4)
    if hasattr(length, "spans"):
        return length.spans(text)
    return lambda start, end: length(text[start:end])


def _cut(text: str, start: int, end: int, sep: str) -> list[tuple[int, int]]:
    """Spans between separators; a separator stays at the head of the span it opens."""
    bounds = [start]
    at = text.find(sep, start + 1, end)
    while at != -1:
        bounds.append(at)
        at = text.find(sep, at + len(sep), end)
    return list(zip(bounds, bounds[1:] + [end]))


def _fixed_cut(start: int, end: int, size: int, measure) -> list[tuple[int, int]]:
    """Widest spans that still measure at most ``size``, one character at least; length grows with the span.

    The width is doubled until it is too much and then bisected, so no span much longer than the result is measured
    and the whole takes time in proportion to the text.
    """
    spans, width = [], 1
    while start < end:
        fits, step = start + 1, width
        while fits + step <= end and measure(start, fits + step) <= size:
            fits += step
            step *= 2
        low, high = fits, min(end, fits + step)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if measure(start, mid) <= size else (low, mid - 1)
        spans.append((start, low))
        width, start = max(1, (low - start) // 2), low
    return spans


def _pack(pieces: list[tuple[int, int]], size: int, overlap: int, measure) -> list[tuple[int, int]]:
    """Greedy runs of adjacent pieces; each run after the first opens with the longest
    whole-piece tail of its predecessor that measures at most ``overlap`` and leaves room."""
    runs, first = [], 0
    for i in range(1, len(pieces) + 1):
        if i < len(pieces) and measure(pieces[first][0], pieces[i][1]) <= size:
            continue
        stop = pieces[i - 1][1]
        runs.append((pieces[first][0], stop))
        if i == len(pieces):
            break
        tail = i
        while tail - 1 > first and measure(pieces[tail - 1][0], stop) <= overlap \
                and measure(pieces[tail - 1][0], pieces[i][1]) <= size:
            tail -= 1
        first = tail
    return runs


def _spans(text: str, start: int, end: int, level: int, size: int, overlap: int, measure) -> list[tuple[int, int]]:
    while level < len(SEPARATORS) and text.find(SEPARATORS[level], start + 1, end) == -1:
        level += 1
    if level == len(SEPARATORS):
        return _pack(_fixed_cut(start, end, max(1, overlap or size), measure), size, overlap, measure)
    out, held = [], []
    for span in _cut(text, start, end, SEPARATORS[level]):
        if measure(*span) <= size:
            held.append(span)
            continue
        if held:
            out += _pack(held, size, overlap, measure)
            held = []
        out += _spans(text, *span, level + 1, size, overlap, measure)
    return out + (_pack(held, size, overlap, measure) if held else [])


def split_text(text: str, size: int, overlap: int, length=estimate_tokens) -> list[str]:
    """Chunks of one text: blank line, line, word and fixed-width boundaries, tried in this order."""
    measure = _measure(text, length)
    if measure(0, len(text)) <= size:
        pieces = [text]
    else:
        pieces = [text[a:b] for a, b in _spans(text, 0, len(text), 0, size, overlap, measure)]
    return [p for p in (piece.strip() for piece in pieces) if p]


def recursive_chunks(c: Column, size: int, overlap: int, length=estimate_tokens) -> Column:
    """ARRAY<STRING> of the chunks of each text; ``length`` measures tokens. One text at a time per task."""
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        return text_by_text(texts, lambda text: split_text(text, size, overlap, length), pa.list_(pa.string()))

    return split(c)


def window_chunks(c: Column, size: int, overlap: int) -> Column:
    """ARRAY<STRING> of windows of ``size`` words, each sharing ``overlap`` words with the one before.

    The words are bound to a lambda variable, so that a text is split once and not once per window.
    """
    def windows(words):
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - overlap), F.lit(size - overlap))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))

    return F.when(c.isNotNull(), F.transform(F.array(F.split(c, r"\s+")), windows)[0])


def merge_tail(chunks: Column, size: int, min_ratio: float = fv.MIN_RATIO) -> Column:
    """A last chunk shorter than ``int(size * min_ratio)`` tokens joins its predecessor with one blank."""
    n = F.size(chunks)
    last = F.element_at(chunks, -1)
    short = (n > 1) & (token_estimate(last) < int(size * min_ratio))
    merged = F.concat(F.slice(chunks, 1, F.greatest(n - 2, F.lit(0))),
                      F.array(F.concat(F.try_element_at(chunks, F.lit(-2)), F.lit(" "), last)))
    return F.when(short, merged).otherwise(chunks)


def cap_chunks(chunks: Column, limit: int = fv.MAX_CHUNKS_PER_DOC) -> Column:
    """The feature's own limit on chunks per document; applies after the tail merge."""
    return F.slice(chunks, 1, limit)


def check_strategy(strategy: str, size: int, overlap: int) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unsupported chunking strategy {strategy!r}; available: {', '.join(STRATEGIES)}")
    if not 0 <= overlap < size:
        raise ValueError(f"chunk overlap must lie in [0, {size}), got {overlap}")


def chunk_documents(df: DataFrame, text_col: str = "text", strategy: str = fv.CHUNK_STRATEGY,
                    size: int = fv.CHUNK_SIZE, overlap: int = fv.CHUNK_OVERLAP, min_ratio: float = fv.MIN_RATIO,
                    max_chunks: int = fv.MAX_CHUNKS_PER_DOC, max_bytes: int = fv.MAX_TEXT_BYTES,
                    length=estimate_tokens, truncated: Observation | None = None) -> DataFrame:
    """One row per chunk (chunk_index, chunk_text) beside the other columns; no shuffle.

    ``truncated`` counts documents with more than ``max_chunks`` chunks. Blank and oversized texts give no rows. Each step is its own projection so that the chunk array
    is computed once.
    """
    check_strategy(strategy, size, overlap)
    text = F.col(text_col)
    rest = [c for c in df.columns if c != text_col]
    # Unusable texts become null, not filtered out: a filter would be pushed below the projection
    # that made the text and compute it twice.
    usable = F.when(has_text(text) & within_bytes(text, max_bytes), text)
    pieces = window_chunks(F.col("_usable"), size, overlap) if strategy == "window" else \
        recursive_chunks(F.col("_usable"), size, overlap, length)
    merged = (df.select(*rest, usable.alias("_usable"))
              .select(*rest, pieces.alias("_chunks"))
              .select(*rest, merge_tail(F.col("_chunks"), size, min_ratio).alias("_chunks")))
    if truncated is not None:
        merged = merged.observe(truncated, F.count_if(F.size("_chunks") > max_chunks).alias("n"))
    return merged.select(*rest, F.posexplode(cap_chunks(F.col("_chunks"), max_chunks)).alias("chunk_index", "chunk_text"))


def chunk_rows(df: DataFrame, strategy: str, size: int, overlap: int) -> DataFrame:
    """Attach the chunking parameters and the content hash."""
    return (df.withColumn("cleaned_text", F.col("chunk_text"))
            .withColumn("chunk_strategy", F.lit(strategy))
            .withColumn("chunk_size", F.lit(size)).withColumn("chunk_overlap", F.lit(overlap))
            .withColumn("content_hash", content_hash(F.col("chunk_text"), F.col("chunk_strategy"),
                                                     F.col("chunk_size"), F.col("chunk_overlap"))))
