"""Sets of hashed word shingles, worked out inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from thermocline.llm.common import TASK_CACHES

WORDS = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


#: Words whose hashes are kept. Beyond that a word is hashed sooner than found: a large dictionary lies in slow memory.
KEPT_WORDS = 10_000


class WordHashes(dict):
    """64-bit hashes of the first KEPT_WORDS words of a task (emptied when it ends)."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64 and len(self) < KEPT_WORDS:
            self[word] = h
        return h


_HASHES = WordHashes()
TASK_CACHES.append(_HASHES)


def words_of(text: str) -> list[bytes]:
    """Words of a text: A-Z lower-cased, split at ASCII white space."""
    return text.encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    full = len(_HASHES) >= KEPT_WORDS
    return np.fromiter(map(xxhash.xxh3_64_intdigest if full else _HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, k: int = WORDS, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` words; of all words together if there are fewer; none without words."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    m = max(1, n - k + 1)
    out = np.full(m, 0x51ED270B + 977 * min(n, k) + 7919 * seed, np.uint64)
    for j in range(min(n, k)):
        out = mixed(out + hashes[j : j + m] * _FACTORS[j])
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting integers is several times faster than hashing them one by one."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_set(text: str, seed: int = 0) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return distinct(shingle_hashes(word_hashes(words_of(text)), seed=seed))


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """Two integers that stand for a set of hashes, signed 64-bit."""
    first = xxhash.xxh3_128_intdigest(s.tobytes())
    return (first >> 64) - (1 << 63), (first & ((1 << 64) - 1)) - (1 << 63)


def enough(shared: int, a: int, b: int) -> bool:
    """Whether sets of ``a`` and ``b`` elements that share so many have a Jaccard similarity of 0.75 or more."""
    return 100 * shared >= 75 * (a + b - shared)
