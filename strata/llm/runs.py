"""Words of a slice of texts as 64-bit numbers with their places, and rolling fingerprints of
word sequences, in numpy. What the separators are is a parameter, and case is kept.

Batches of documents exchange fingerprints through buckets: a fingerprint's high half names the
bucket and its low half is what is sent, so what is compared inside a bucket has 32 bits there
and a collision only adds a candidate that the exact step afterwards refuses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import in_slices, mix

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
BASE = np.uint64(0xD6E8FEB86659FD93)
# Characters of the corpus for each batch of documents and for each bucket of fingerprints: so many
# at most, and fewer, down to the least, where tasks would have nothing to do.
BATCH_CHARS, BUCKET_CHARS = 1 << 22, 1 << 24
LEAST_BATCH_CHARS, LEAST_BUCKET_CHARS = 1 << 18, 1 << 20


@dataclass
class Words:
    """Words of some texts: text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``, word
    ``j`` is ``data[starts[j]:ends[j]]`` and lies in piece ``pieces[j]``."""

    data: bytes
    numbers: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    pieces: np.ndarray

    def runs(self, width: int) -> np.ndarray:
        """Whether the words from each place on to ``width`` words later are one piece."""
        if len(self.numbers) < width:
            return np.zeros(0, bool)
        return self.pieces[:len(self.pieces) - width + 1] == self.pieces[width - 1:]


def split_words(texts: list[str], separators: bytes, breaks: bytes = b"", lower: bool = False) -> Words:
    """``breaks`` (separators too) end a piece; so does the end of a text."""
    parts = [t.encode() for t in texts]
    if lower:
        parts = [p.lower() for p in parts]
    data = b"\n".join(parts) + b"\n"
    codes = np.frombuffer(data, np.uint8)
    gap = np.zeros(256, bool)
    gap[list(separators + breaks + b"\n")] = True
    apart = gap[codes]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], apart])))
    starts, ends = edge[0::2], edge[1::2]
    text_at = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    bounds = np.searchsorted(starts, text_at)
    pieces = np.repeat(np.arange(len(parts)), np.diff(bounds))
    if breaks:
        cut = np.zeros(256, bool)
        cut[list(breaks + b"\n")] = True
        pieces = np.searchsorted(np.flatnonzero(cut[codes]), starts)
    if not len(starts):
        return Words(data, np.zeros(0, np.uint64), starts, ends, bounds, pieces)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))])
    values = _BYTE[codes[~apart]] * powers[place]
    return Words(data, mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), starts, ends, bounds, pieces)


def rolling(numbers: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """A 64-bit fingerprint of the ``width`` numbers from each place on."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = numbers[:n].copy()
    for j in range(1, width):
        x *= base
        x += numbers[j:j + n]
    return mix(x)


def text_slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Slices of the texts by bytes, each with the index of its first text."""
    for a, b in in_slices(texts, 1 << 20):
        yield a, texts[a:b]


def keyed(prints: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (high half) and 32-bit fingerprint in the bucket (low half)."""
    return (((prints >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (prints & np.uint64(0xFFFFFFFF))


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and the end."""
    return np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))


def members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values occur in ``among`` (sorted, distinct)."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def arrays(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), kind) for chunk in column.chunks for b in chunk]


def received(table: pa.Table, column: str = "prints") -> np.ndarray:
    """The keys that came back to a batch, sorted."""
    parts = [p.astype(np.uint64) | (np.uint64(b) << np.uint64(32)) for b, p in
             zip(table.column("bucket").to_pylist(), arrays(table.column(column), np.uint32))]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def batch_counts(texts: DataFrame) -> tuple[int, int]:
    """Batches and buckets for ``texts(text)``. Both grow with the characters, so that a batch and a
    bucket stay bounded; a batch sends a bucket one message at most."""
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0] or 0

    def number(most: int, least: int) -> int:
        return max(1, chars // most, min(3 * tasks, chars // least))

    return number(BATCH_CHARS, LEAST_BATCH_CHARS), number(BUCKET_CHARS, LEAST_BUCKET_CHARS)


def batch_number(batches: int, *columns: str) -> Column:
    """The batch of a row, by its content: copies of a text with ids of their own spread over
    the batches, and a lost task finds the same batches again."""
    return F.pmod(F.xxhash64(*columns), F.lit(batches)).alias("batch")
