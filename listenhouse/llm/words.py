"""Words and word windows of whole Arrow string columns, in numpy.

Texts are handled as one UTF-8 buffer per slice of a batch. ``SPACED`` words
are runs of anything but ``\\x20 \\x09-\\x0D``; ``ALNUM`` words are runs of a-z,
0-9 and everything from U+0080 on. A word is known by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_BYTES = np.arange(256)
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

_RANDOM = np.random.default_rng(20240101)
_OF_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_IN_WORD = np.uint64(0x9E3779B97F4A7C15)
_IN_WINDOW = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... mod 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def running(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for every n of ``lengths``, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has about ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of n texts: where they start and end in ``data``, their hashes, and ``bounds[i]:bounds[i + 1]`` of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words(column: pa.Array, members: np.ndarray = SPACED, lower: bool = False) -> Words:
    raw, offsets = utf8(column)
    data = LOWER[raw] if lower else raw
    inside = members[data]
    first = inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        first[heads] = inside[heads]  # words never cross texts
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(np.cumsum(inside)[starts] - 1, int(inside.sum()))) if len(starts) else np.zeros(0, np.int64)
    values = _OF_BYTE[data[inside]] * powers(_IN_WORD, int(lengths.max(initial=0)))[running(lengths)]
    hashes = mix(np.add.reduceat(values, np.cumsum(lengths) - lengths)) if len(starts) else np.zeros(0, np.uint64)
    return Words(raw, starts, starts + lengths, np.searchsorted(starts, offsets), hashes)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words, wherever it starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(_IN_WINDOW, size)):
        total += hashes[j : j + n] * p
    return mix(total + np.uint64(size))


def shingles(w: Words, size: int) -> Iterator[np.ndarray]:
    """Per text its distinct windows of ``size`` words, sorted; a shorter text is one window of all its words."""
    every = windows(w.hashes, size)
    for a, b in zip(w.bounds[:-1], w.bounds[1:]):
        if b - a >= size:
            yield np.unique(every[a : b - size + 1])
        else:
            yield windows(w.hashes[a:b], int(b - a)) if b > a else every[:0]


class MinHash:
    """``size`` universal hash functions x -> a x + b mod 2^64; the least value of each over a set."""

    def __init__(self, size: int, seed: int = 1):
        random = np.random.default_rng(seed)
        self.size = size
        self.a = random.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = random.integers(0, 2**63, size, dtype=np.uint64)

    def __call__(self, items: np.ndarray, block: int = 4096) -> np.ndarray:
        """The signature; all ones for the empty set."""
        least = np.full(self.size, np.iinfo(np.uint64).max)
        for i in range(0, len(items), block):
            least = np.minimum(least, (items[i : i + block, None] * self.a + self.b).min(axis=0))
        return least
