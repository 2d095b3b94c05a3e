"""Five-word shingle hashes in numpy, for the operators that link texts.

Words: A-Z lower-cased, cut at \\x20 and \\x09-\\x0D. Shingles: runs of five
words; with fewer, the whole sequence as one; without words, none. A shingle's
hash mixes its words' 64-bit hashes in order and is kept to 63 bits, so that
it fits Spark's long.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class _Words(dict):
    """Hashes of words, kept up to a bound."""

    KEPT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = h
        return h


_known = _Words()


def _mixed(parts: list[np.ndarray], n: int) -> np.ndarray:
    acc = np.full(len(parts[0]), n, np.uint64)
    for p in parts:
        acc = (acc ^ p) * _MULTIPLY
        acc ^= acc >> _SHIFT
    acc *= _MULTIPLY
    return (acc ^ acc >> np.uint64(32)) >> np.uint64(1)


def shingle_hashes(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Hashes (int64, not negative) of the shingles in order, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    if len(h) < n:
        return _mixed([h[i:i + 1] for i in range(len(h))], len(h)).view(np.int64)
    m = len(h) - n + 1
    return _mixed([h[i:i + m] for i in range(n)], n).view(np.int64)
