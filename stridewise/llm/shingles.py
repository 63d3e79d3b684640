"""Word shingles of texts as sorted arrays of 64-bit hashes, computed in numpy inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept for the frequent ones."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased words between ASCII white space, as UTF-8 bytes."""
    return text.encode("utf-8").lower().split() if text else []


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence if shorter; empty without words."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = hashes.of(words)
    width = min(k, len(words))
    with np.errstate(over="ignore"):
        acc = mix64(h[: len(h) - width + 1] + np.uint64(width))
        for j in range(1, width):
            acc = mix64(acc * np.uint64(3) + h[j : len(h) - width + 1 + j])
    return np.unique(acc)


def set_key(shingles: np.ndarray) -> int:
    """One signed 64-bit value for equal sets."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def parity(shingles: np.ndarray) -> bytes:
    """For each cell of a power-of-two table of about the set's size whether it holds an odd number of hashes."""
    cells = 8 << max(0, (len(shingles) - 1).bit_length() - 3)
    odd = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference of two sets, from their parities."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int.from_bytes((x ^ y).tobytes(), "little").bit_count()
