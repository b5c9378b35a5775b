"""Words of texts as numbers, for the operators on word sequences."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

U64 = np.uint64
#: Multiplier of the polynomial over word hashes, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
#: Words whose hashes a worker remembers, and the bytes such a word has at most.
KNOWN, KNOWN_BYTES = 1 << 18, 32


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < KNOWN and len(word) <= KNOWN_BYTES:
            self[word] = value
        return value


HASHES = WordHashes()


def words_of(text: str) -> list[bytes]:
    """The maximal stretches without ASCII white space."""
    return text.encode("utf-8", "replace").split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), U64, len(words))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A second hash of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = x + U64((BASE * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


@lru_cache(maxsize=2)
def powers(base: int, n: int) -> np.ndarray:
    """``base ** k`` modulo 2^64 for k < n."""
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Hashes of any stretch of a sequence of word hashes."""

    def __init__(self, words: np.ndarray):
        room = 1 << max(len(words), 1).bit_length()  # few different lengths
        self.inverse = powers(UNBASE, room)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(words * powers(BASE, room)[: len(words)], dtype=U64)])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            found = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
            return mixed(found + np.asarray(length).astype(U64))
