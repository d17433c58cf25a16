"""Hashes of words and word shingles of whole columns of text, with numpy.

Works on the bytes of an Arrow column, a few megabytes at a time, so that the
scratch arrays stay small however long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20

# Odd multipliers of the word polynomial and of the places in a
# shingle, and those of the 64-bit finaliser.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly; different values stay different."""
    with np.errstate(over="ignore"):
        out = values.astype(np.uint64, copy=True)
        out ^= out >> np.uint64(30)
        out *= _M1
        out ^= out >> np.uint64(27)
        out *= _M2
        out ^= out >> np.uint64(31)
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column and where each text begins; NULL is empty."""
    filled = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``most`` bytes; a longer text is a run of its own."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, count)
        first = min(last, count)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash per word, and the words before each text.

    Words are runs of bytes other than ASCII spaces; a text's end ends a word.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] |= ~space[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    number = np.cumsum(first)
    place = np.arange(len(data)) - starts[np.maximum(number - 1, 0)]
    place[space] = 0
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(place.max()) + 1, _BASE))
        parts = (data.astype(np.uint64) + np.uint64(1)) * powers[place]
        parts[space] = 0
        hashes = mixed(np.add.reduceat(parts, starts))
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash per run of ``width`` words inside a text, and the runs before each text.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    counts = np.diff(offsets)
    short = (counts > 0) & (counts < width)
    sizes = np.where(short, 1, np.maximum(counts - width + 1, 0))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    total = int(ends[-1])
    begin = np.repeat(offsets[:-1] - ends[:-1], sizes) + np.arange(total)
    length = np.repeat(np.minimum(counts, width), sizes)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    with np.errstate(over="ignore"):
        out = length.astype(np.uint64)
        for place in range(width):
            word = padded[begin + place]
            if short.any():
                word = np.where(place < length, word, np.uint64(0))
            out = mixed(out * _PLACE + word)
    return out, ends


def shingles(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first, last, hashes of their shingles, where each text's begin."""
    data, offsets = text_bytes(texts)
    for first, last in chunks(offsets):
        low, high = offsets[first], offsets[last]
        words, word_offsets = word_hashes(data[low:high], offsets[first : last + 1] - low)
        yield first, last, *shingle_hashes(words, word_offsets, width)


def distinct(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[keep], minlength=len(offsets) - 1)
    return hashes[keep], np.concatenate([[0], np.cumsum(counts)])
