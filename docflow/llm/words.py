"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base of the word hash, modulo 2**64."""
    global _POWERS
    while len(_POWERS) < n:
        step = np.multiply(_POWERS[-1], _BASE)
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the text each belongs to."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = _SPACE[data]
    begins = ~space[1:-1] & space[:-2]
    stops = ~space[1:-1] & space[2:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[inner] |= ~space[1:-1][inner]  # a word never crosses from one text to the next
    stops[inner - 1] |= ~space[1:-1][inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``lower`` counts A-Z as a-z."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = (_LOWER[data] if lower else data)[np.repeat(starts, sizes) + within].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(letters * powers(int(sizes.max()))[within], first))


def pairs(hashes: np.ndarray, texts: np.ndarray, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of two words with ``skip`` words between them, and their texts."""
    step = 1 + skip
    same = texts[step:] == texts[:-step]
    both = mixed(hashes[:-step] * np.uint64(3 + 2 * skip) + hashes[step:] + np.uint64(skip))
    return both[same], texts[step:][same]
