"""Hashes of word shingles in numpy: 64 bits each, the same in every process."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import claim

#: Words whose hashes a Python worker remembers; at that number it forgets all of them.
MOST_WORDS = 500_000
#: Shingles hashed under all permutations at a time.
CHUNK = 4096
U = np.uint64


class WordHashes(dict):
    """64-bit hash of each word (bytes)."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = WordHashes()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def word_hashes(words: list[bytes]) -> np.ndarray:
    claim("shingles", _words.clear)
    if len(_words) > MOST_WORDS:
        _words.clear()
    return np.fromiter(map(_words.__getitem__, words), U, len(words))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a text, A-Z lower-cased, words cut at ASCII blanks.

    A text of fewer words has one shingle, its whole word sequence; a text without words none.
    """
    h = word_hashes((text or "").encode().lower().split())
    n = len(h)
    if not n:
        return h
    c = constants(11, size)
    if n < size:
        return mix(np.array([(h * c[:n]).sum() + U(n)], U))
    total = h[: n - size + 1] * c[0]
    for k in range(1, size):
        total += h[k: n - size + 1 + k] * c[k]
    return np.unique(mix(total))


def least_and_most(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum (upper 32 bits) of the hashes under each permutation a * h + b; h must not be empty."""
    low, high = np.full(len(a), 2**32 - 1, U), np.zeros(len(a), U)
    for k in range(0, len(h), CHUNK):
        p = (h[None, k: k + CHUNK] * a[:, None] + b[:, None]) >> U(32)
        np.minimum(low, p.min(axis=1), out=low)
        np.maximum(high, p.max(axis=1), out=high)
    return low, high
