"""Hashed words for the operators on word runs."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Runs of letters, digits or underscores.
WORD = re.compile(r"\w+")
#: Words without underscores, for comparisons in which spelling marks do not matter.
PLAIN_WORD = re.compile(r"[^\W_]+")


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound so that a worker's memory stays level."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x2545F4914F6CDD1D, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def runs(hashes: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Hashes of the words at `offsets` from each position; the last offset is the longest."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k, offset in enumerate(offsets):
        total += hashes[offset : offset + n] * _ODD[k]
    return mix(total)
