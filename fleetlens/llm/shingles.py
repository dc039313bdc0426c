"""Word hashes and five-word shingle sets of texts, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from fleetlens.llm.caches import worker_cache

WORDS = 5
CACHE_WORDS = 300_000
_TURNS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class WordCache(dict):
    """64-bit hash of a word, kept for words seen before; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words (runs of other than space and 0x09-0x0D), A-Z lowered."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    hashes = worker_cache("words", WordCache)
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; of fewer words, one
    hash of them all; empty without words."""
    w = word_hashes(text)
    if len(w) < WORDS:
        if not len(w):
            return w
        return mix((w * _TURNS[: len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(w)))
    n = len(w) - WORDS + 1
    total = w[:n] * _TURNS[0]
    for i in range(1, WORDS):
        total += w[i: n + i] * _TURNS[i]
    return np.unique(mix(total))
