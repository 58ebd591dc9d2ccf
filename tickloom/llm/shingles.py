"""Word shingles of one text as sorted 64-bit numbers, and their minwise signature (numpy, used inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
COORDINATES = 64
CACHE_WORDS = 200_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


class _Words(dict):
    """Word to its hash; emptied when full, so its size is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    state = np.arange(1, 2 * n + 1, dtype=np.uint64) * _PRIME
    values = _mixed(state)
    return values[:n] | np.uint64(1), values[n:]


_A, _B = _factors(COORDINATES)


def shingle_set(text: str | None, length: int = SHINGLE) -> np.ndarray:
    """Distinct shingles. Words are runs of anything but ASCII white space; fewer than ``length`` words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    size = min(length, n)
    h = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        h = _mixed(h * _PRIME + hashes[k:n - size + 1 + k])
    return np.unique(h)


def set_id(shingles: np.ndarray) -> str | None:
    """96 bits that stand for the set."""
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())[:24] if len(shingles) else None


def signature(shingles: np.ndarray) -> bytes:
    """The smallest of ``COORDINATES`` hashes each, 4 bytes per coordinate; blocks keep memory level for long texts."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        block = shingles[at:at + 4096, None] * _A + _B
        np.minimum(best, block.min(axis=0), out=best)
    return (best >> _SHIFT).astype(np.uint32).tobytes()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
