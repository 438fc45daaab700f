"""Pluggable embedding providers and the batched embedding operator."""

import functools
import itertools
from typing import Iterator, Protocol

try:  # without the ceremony that costs most of a short word's time
    from _md5 import md5
except ImportError:
    from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv


class EmbeddingProvider(Protocol):
    """What a provider offers; built once per Python worker by its registered factory."""

    model: str

    @property
    def dimensions(self) -> int: ...

    def embed_text(self, text: str) -> list[float]: ...

    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...

    # A provider may also have ``embed_array``, which gives the vectors of a batch as the rows of a float32 matrix.


_PROVIDERS: dict[str, object] = {}


def register_provider(name: str):
    """Class decorator that makes a provider available by name."""
    def add(factory):
        _PROVIDERS[name] = factory
        return factory
    return add


def provider_factory(name: str, **options):
    """Factory of the named provider with its options bound; ValueError for an unknown name."""
    if name not in _PROVIDERS:
        raise ValueError(f"unknown embedding provider {name!r}; available: {sorted(_PROVIDERS)}")
    return functools.partial(_PROVIDERS[name], **options)


class _WordCodes(dict):
    """Of a word's MD5 the first 32 bits, and behind them a bit for its sign; so many words are remembered by a worker."""

    def __init__(self, words: int = 1 << 18):
        super().__init__()
        self.words = words

    def __missing__(self, word: str) -> int:
        digest = md5(word.encode("utf-8")).digest()
        code = int.from_bytes(digest[:4], "big") << 1 | digest[4] >> 7
        if len(self) < self.words:
            self[word] = code
        return code


_CODES = _WordCodes()


@register_provider("hashing")
class HashingProvider:
    """Signed feature hashing of lower-cased words (Weinberger et al., 2009), scaled to unit length.

    Works offline and is deterministic. It compares words, not meanings.
    """

    model = "hashing"

    def __init__(self, dims: int = fv.EMBED_DIMS):
        self._dims = dims

    @property
    def dimensions(self) -> int:
        return self._dims

    def embed_array(self, texts: list[str]) -> np.ndarray:
        code_of = _CODES.__getitem__
        found = [list(map(code_of, text.lower().split())) for text in texts]
        codes = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        places = 2 * (self._dims * row + (codes >> 1) % self._dims) + (codes & 1)
        counts = np.bincount(places, minlength=2 * self._dims * len(texts)).reshape(len(texts), self._dims, 2)
        matrix = (counts[:, :, 0] - counts[:, :, 1]).astype(np.float64)
        norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        return (matrix / np.where(norms == 0, 1.0, norms)).astype(np.float32)

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        return self.embed_array(texts).tolist()

    def embed_text(self, text: str) -> list[float]:
        return self.embed_batch([text])[0]


_RESULT = T.StructType([
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("error", T.StringType()),
])


_ARROW_RESULT = pa.struct([("embedding", pa.list_(pa.float32())), ("error", pa.string())])


def _safe_batch(provider, texts: list[str], fail_fast: bool) -> list[dict]:
    """Embed a batch; if it fails, text by text, so that one bad text costs only itself."""
    present = [t for t in texts if t is not None]
    try:
        vectors = provider.embed_batch(present) if present else []
        if len(vectors) != len(present):
            raise ValueError(f"provider returned {len(vectors)} vectors for {len(present)} texts")
        outcome = [(v, None) for v in vectors]
    except Exception:
        outcome = []
        for text in present:
            try:
                outcome.append((provider.embed_text(text), None))
            except Exception as exc:
                if fail_fast:
                    raise
                outcome.append((None, f"{type(exc).__name__}: {exc}"))
    done = iter(outcome)
    rows = []
    for text in texts:
        vector, error = next(done) if text is not None else (None, None)
        if vector is not None and len(vector) != provider.dimensions:
            vector, error = None, f"provider returned {len(vector)} dimensions, expected {provider.dimensions}"
        rows.append({"embedding": vector, "error": error})
    return rows


def _embedded(provider, texts: pa.Array, fail_fast: bool) -> pa.Array:
    """Vectors and errors of a batch."""
    if hasattr(provider, "embed_array"):
        present = texts.drop_null()
        try:
            matrix = provider.embed_array(present.to_pylist())
        except Exception:
            matrix = None  # text by text, below
        if matrix is not None and matrix.shape == (len(present), provider.dimensions):
            counts = np.where(texts.is_valid().to_numpy(zero_copy_only=False), provider.dimensions, 0)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            vectors = pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), pa.float32()), mask=texts.is_null())
            return pa.StructArray.from_arrays([vectors, pa.nulls(len(texts), pa.string())], fields=list(_ARROW_RESULT))
    return pa.array(_safe_batch(provider, texts.to_pylist(), fail_fast), _ARROW_RESULT)


def embed(df: DataFrame, text_col: str = "cleaned_text", provider: str = "hashing", batch_size: int = fv.EMBED_BATCH,
          fail_fast: bool = False, **options) -> DataFrame:
    """Add ``embedding`` and ``embed_error``. Map-only: batches fill up across documents.

    A provider may be remote and costly, so the call counts as non-deterministic: the optimizer
    neither duplicates nor moves it. Write the result once and read it from there.
    """
    factory = provider_factory(provider, **options)

    @F.arrow_udf(_RESULT)
    def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        instance = factory()  # once per task
        for texts in batches:
            done = [_embedded(instance, texts.slice(at, batch_size), fail_fast) for at in range(0, len(texts), batch_size)]
            yield pa.concat_arrays(done) if done else pa.array([], _ARROW_RESULT)

    call = call.asNondeterministic()
    return (df.withColumn("_embedded", call(F.col(text_col)))
            .withColumn("embedding", F.col("_embedded.embedding"))
            .withColumn("embed_error", F.col("_embedded.error")).drop("_embedded"))


def embed_query(spark: SparkSession, text: str, provider: str = "hashing", **options) -> list[float]:
    """The vector of one search text, by the same provider as the chunks."""
    return list(provider_factory(provider, **options)().embed_text(text))
