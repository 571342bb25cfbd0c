"""Word hashes and 64-bit mixing for operators that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
M1, M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64-bit integers."""
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants from a seed."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered for up to ``LIMIT`` words."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U, count=len(words))


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (``bytes.split`` cuts at exactly those six), with A-Z
    lower-cased on request; null: none."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.translate(LOWER) if lower else data).split()


def windows(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values, by doubling: the hash of a run is made from two
    overlapping runs of the largest power of two that fits."""
    if len(h) < k:
        return np.empty(0, dtype=U)
    a, b = constants(2, seed)
    size, cur = 1, mix(h + U(seed))
    while size * 2 <= k:
        cur = mix(cur[:-size] * a + cur[size:] * b + U(size))
        size *= 2
    if size == k:
        return cur
    rest = k - size
    return mix(cur[: len(h) - k + 1] * a + cur[rest: rest + len(h) - k + 1] * b + U(k))
