"""Words, shingles and their hashes for whole Arrow columns of text, without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

BYTES = np.arange(256)
LOWER = BYTES.astype(np.uint8)
LOWER[65:91] += 32
NOT_SPACE = ~((BYTES == 32) | ((BYTES >= 9) & (BYTES <= 13)))
"""Bytes of words that end at ASCII white space."""
ALPHANUMERIC = ((BYTES >= 48) & (BYTES <= 57)) | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)
"""Bytes of words that end at anything but a lower-case letter, a digit or a character beyond ASCII."""

_powers = {base: np.ones(1, dtype=np.uint64) for base in (BASE, BASE_INVERSE)}


def _power(base: np.uint64, size: int) -> np.ndarray:
    if len(_powers[base]) < size:
        grown = np.full(max(size, CHUNK_BYTES + 1), base, dtype=np.uint64)
        grown[0] = 1
        grown = np.multiply.accumulate(grown)
        if size > 4 * CHUNK_BYTES:  # one very long text; not kept
            return grown
        _powers[base] = grown
    return _powers[base][:size]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Chunk:
    """Some consecutive texts of a column as one run of bytes.

    ``data`` has A-Z lower-cased, ``raw`` is as given.  Word ``w`` is ``data[starts[w]:ends[w]]``; text ``i`` has the words
    ``bounds[i]`` to ``bounds[i + 1]`` and the bytes ``offsets[i]`` to ``offsets[i + 1]``.
    """

    first: int
    raw: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bounds) - 1

    def word(self, w: int) -> bytes:
        return self.data[self.starts[w] : self.ends[w]].tobytes()

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.size), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.data * _power(BASE, n), out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * _power(BASE_INVERSE, n + 1)[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def shingles(self, words: int, hashed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, first word) of every run of ``words`` words.

        A text of fewer words has one shingle, its whole sequence; one without words has none.
        """
        h = self.hashes() if hashed is None else hashed
        counts = np.diff(self.bounds)
        owner = np.repeat(np.arange(self.size), counts)
        place = np.arange(len(h)) - self.bounds[:-1][owner]
        first = np.flatnonzero((place + words <= counts[owner]) | ((place == 0) & (counts[owner] < words)))
        length = np.minimum(counts[owner[first]], words)
        out = np.zeros(len(first), dtype=np.uint64)
        for k in range(words):
            there = length > k
            out[there] = mix(out[there] + h[first[there] + k] * np.uint64(2 * k + 1))
        return out, owner[first], first


def byte_runs(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts, about ``limit`` bytes at a time; nulls are empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def chunks(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column with A-Z lower-cased, cut into words of ``word_bytes``."""
    for lo, raw, offsets in byte_runs(column, limit):
        data = LOWER[raw]
        inside = word_bytes[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        yield Chunk(lo, raw, data, offsets, starts, ends, np.searchsorted(starts, offsets))
