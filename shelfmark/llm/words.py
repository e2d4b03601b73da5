"""Words and shingles of a text, as numpy arrays of 64-bit hashes.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``; ``bytes.split`` and
``bytes.lower`` know only ASCII, so this is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

KNOWN_WORDS = 50_000  # size at which a worker forgets the hashes it remembers

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """Hash of a word; words seen before are looked up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def give_back(*caches: dict) -> None:
    """Forget what a task remembered and return freed memory to the system: Spark runs the tasks
    of later stages in the same worker, which would otherwise keep the most that any task took."""
    for cache in caches:
        cache.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch, rows: int = 250):
    """Parts of an Arrow batch, whose results are sent off before the next one is begun."""
    for start in range(0, len(batch), rows):
        yield batch.iloc[start : start + rows]


def to_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each number; one-to-one."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; of the whole sequence, if it has fewer words."""
    k = min(k, len(h))
    if not k:
        return h
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * _MIX[0] + h[j : len(h) - k + 1 + j]
        out ^= out >> np.uint64(29)
    return mixed(out)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's BIGINT."""
    return np.ascontiguousarray(h, np.uint64).view(np.int64)
