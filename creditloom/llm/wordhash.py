"""Hashes of the words of many texts at once: each word's XXH64, and mixtures of runs of words."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import xxhash


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all of them, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: list[str | None], lower: bool = False) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in one list, and where each text's words begin (one more bound at the end).

    Words are runs of anything but ASCII white space; ``lower`` lower-cases A-Z only. A null text has none.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    parts = [(e.lower() if lower else e).split() for e in encoded]
    return list(chain.from_iterable(parts)), np.cumsum([0, *map(len, parts)], dtype=np.int64)


def word_hashes(words: list[bytes], seed: int = 42) -> np.ndarray:
    """XXH64 of every word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the ``size``-word shingles of every text; a text with fewer words has its whole sequence as one.

    The number of words is part of a hash, so a short sequence equals no shingle of another text.
    """
    count = np.diff(bounds)
    room = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    made = np.zeros(int(room.sum()), np.uint64)
    begin = np.cumsum(room) - room
    text = np.repeat(np.arange(len(count)), room)
    first = np.arange(len(made)) - begin[text] + bounds[:-1][text]
    width = np.minimum(count, size)[text]
    for k in range(size):
        inside = width > k
        made = np.where(inside, made * np.uint64(0x9E3779B97F4A7C15) + hashes[np.where(inside, first + k, 0)], made) if len(hashes) else made
    return mixed(made + width.astype(np.uint64)), np.r_[0, np.cumsum(room)].astype(np.int64)
