"""Words and shingles of texts as 64-bit numbers, a batch at a time in numpy.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. Its number is a polynomial over
its bytes, finished by an avalanche step; numbers are the same in every process and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 1 << 18  # the arrays of a slice take some 50 times that
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(numbers, bounds)``: the words of text ``i`` are ``numbers[bounds[i]:bounds[i + 1]]``."""
    parts = [t.encode().lower() for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
    starts, ends = edge[0::2], edge[1::2]
    text_at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    bounds = np.searchsorted(starts, text_at)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))])
    values = _BYTE[data[~space]] * powers[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), bounds


def in_slices(texts: list[str], chars: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chars`` characters each (a longer text is a range)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of ``size`` words of each text; a text with fewer words is
    one shingle, one without words has none."""
    for a, b in in_slices(texts):
        numbers, bounds = word_numbers(texts[a:b])
        for i in range(b - a):
            w = numbers[bounds[i]:bounds[i + 1]]
            k = min(size, len(w))
            if not k:
                yield w
                continue
            x = w[:len(w) - k + 1]
            for j in range(1, k):
                x = mix(x * _PRIME + w[j:len(w) - k + 1 + j])
            yield np.unique(mix(x + np.uint64(k)))
