"""Words and word-shingle hashes of whole texts, vectorised; used inside Arrow tasks.

A word is a run of bytes outside [\\x20\\x09-\\x0D] after lower-casing A-Z only,
which is what bytes.split() and a 256-byte table give.
"""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MEMO_ENTRIES = 400_000


class WordHashes(dict):
    """word -> 64-bit hash; forgets everything when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def hash_words(words: list[bytes], memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash for each run of `size` words, in order; all words as one shingle when there are fewer; none without words."""
    n = min(size, len(hashes))
    if not n:
        return hashes
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i])
    return out
