"""Words and shingles of a text, as hashes, inside tasks.

Words are runs of anything but ASCII white space, with A-Z in lower case. Five
successive words are a shingle; a text of fewer words is one shingle of all of them; a text
without words, or none at all, has no shingle.
"""

import numpy as np
import xxhash

WORDS = 5
# Odd 64-bit multipliers for the five places of a shingle, from the fractions of roots.
PLACES = np.array([int(2**64 * (root % 1)) | 1 for root in (2**0.5, 3**0.5, 5**0.5, 7**0.5, 11**0.5)], dtype=np.uint64)
REMEMBERED = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Turns texts into shingle hashes; remembers the hashes of words it has seen."""

    def __init__(self):
        self._words = _WordHashes()

    def sequence(self, text: str | None) -> np.ndarray:
        """A 64-bit hash for every shingle, in the order of the text."""
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        hashes = np.fromiter(map(self._words.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(words) >= WORDS:
            count = len(words) - WORDS + 1
            mixed = hashes[:count] * PLACES[0]
            for i in range(1, WORDS):
                mixed += hashes[i : count + i] * PLACES[i]
        else:
            mixed = (hashes * PLACES[: len(words)]).sum(keepdims=True, dtype=np.uint64)[: min(1, len(words))]
            mixed += np.uint64(len(words))
        return _spread(mixed)

    def distinct(self, text: str | None) -> np.ndarray:
        """The set of shingles, sorted."""
        return np.unique(self.sequence(text))


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * PLACES[0]
    x = (x ^ (x >> np.uint64(29))) * PLACES[1]
    return x ^ (x >> np.uint64(32))


class MinHash:
    """``count`` random orders of 32-bit shingle hashes."""

    def __init__(self, count: int, seed: int):
        rng = np.random.default_rng(seed)
        self._a = (rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1))[:, None]
        self._b = rng.integers(0, 2**32, count, dtype=np.uint32)[:, None]

    def ordered(self, shingles: np.ndarray) -> np.ndarray:
        """Every shingle's place in every order: one row per order."""
        return self._a * (shingles >> np.uint64(32)).astype(np.uint32) + self._b

    def signature(self, shingles: np.ndarray, step: int = 4096) -> np.ndarray:
        """The smallest place in every order."""
        parts = [self.ordered(shingles[i : i + step]).min(axis=1) for i in range(0, len(shingles), step)]
        return np.minimum.reduce(parts)
