"""Word shingles as 64-bit hashes, vectorised over a batch of texts."""

from __future__ import annotations

import numpy as np
import xxhash

from starloom.llm.common import claim, words

WIDTH = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    """Word -> 64-bit hash; emptied when large, so a worker's memory stays bounded."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def keep_hashes() -> None:
    """Keep the hashes between tasks until another operator uses the worker."""
    claim("shingles", _HASHES.clear)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _END
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes. Fewer than ``width`` words: the whole sequence is the one
    shingle; no word: empty."""
    own = words(text)
    n = len(own)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, own), np.uint64, n)
    size = min(n, width)
    h = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        h = (h ^ w[k : n - size + 1 + k]) * _MUL
        h ^= h >> np.uint64(31)
    return np.unique(_finish(h))


def set_key(shingles: np.ndarray) -> bytes:
    """128-bit key of a set: texts with equal sets share it."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
