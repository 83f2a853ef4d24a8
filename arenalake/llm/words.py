"""Words as bytes and their 64-bit hashes, for the Arrow tasks of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash. Emptied when it has grown to `most` words, so a task's memory is bounded."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def lower_words(text: str | bytes | None) -> list[bytes]:
    """A-Z lower-cased, split at blank, \\t, \\n, \\v, \\f, \\r: exactly what bytes methods do."""
    if text is None:
        return []
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    return text.lower().split()


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _STEP + h[j:j + n]
    return mix(out)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k-word windows; fewer words count as one shingle, none as no shingle."""
    if len(h) == 0:
        return h
    if len(h) < k:
        return window_hashes(h, len(h)) ^ np.uint64(len(h))
    return np.unique(window_hashes(h, k))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    """Texts as UTF-8 bytes without decoding."""
    return iter(column(batch, "text").cast(pa.binary()).to_pylist())


def small_batches(spark) -> None:
    """Fewer rows and bytes per Arrow batch: documents can be long, and a task holds a batch several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
