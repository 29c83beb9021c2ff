"""Words and hashes of words. A word is a run of characters other than ASCII white space."""

from __future__ import annotations

import numpy as np
import xxhash

#: ASCII white space, as in [\x20\x09-\x0D]; bytes.split() splits at just these.
SPACES = b" \t\n\x0b\x0c\r"
_M1, _M2, _P = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


#: Longer words and runs are not kept in caches: one may be a whole text.
LONGEST = 200


class WordHashes(dict):
    """word -> xxh64 of its bytes; emptied when full, and without long words, so that its memory is bounded."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[word] = h
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def shingle_set(words: list[bytes], n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; fewer words make one shingle, none make none."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _P + h[i : len(h) - k + 1 + i]
    return np.unique(mix(out))
