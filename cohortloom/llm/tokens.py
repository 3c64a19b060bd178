"""Words of many texts as arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

from cohortloom.llm.common import words

# Distinct words a worker remembers before it starts anew.
CACHE = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """Word to its 64-bit hash; the memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = Hashes()


def hashed(found: list[bytes]) -> np.ndarray:
    """Hashes of the words of one text."""
    return np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))


def hashed_text(text: str | None, lower: bool = True) -> np.ndarray:
    return hashed(words(text.lower() if text and lower else text))


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; a shorter text is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    with np.errstate(over="ignore"):
        # runs of ``done`` words are put together from runs of half as many (and one word more)
        total, done, factor = hashes, 1, ODD
        for bit in bin(size)[3:]:
            total = total[: len(total) - done] * factor + total[done:]
            done, factor = 2 * done, factor * factor
            if bit == "1":
                total = total[:-1] * ODD + hashes[done:]
                done, factor = done + 1, factor * ODD
        return scramble(total)


def combined(values: Iterable[int]) -> int:
    """One hash of a short sequence of hashes, as a signed 64-bit number."""
    return as_long(xxhash.xxh3_64_intdigest(np.fromiter(values, np.uint64).tobytes()))


def as_long(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value
