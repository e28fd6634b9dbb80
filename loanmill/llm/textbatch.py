"""Whole texts of an Arrow batch as flat byte and word arrays, so the work per word is vectorised."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes worked on at once. A longer text is one block by itself; its words are hashed in runs of this size.
BLOCK_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACES
# Digits, letters and every byte of a non-ASCII character.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 … 2**bits of the hash base and of its inverse modulo 2**64."""
    both = []
    for base in (_BASE, _INVERSE):
        steps = np.full((1 << bits) + 1, base, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps))
    return both[0], both[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = AS_IS) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), ascending and disjoint, after mapping bytes by `table`."""
    out = np.empty(len(starts), np.uint64)
    values = table.astype(np.uint64) + np.uint64(1)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BLOCK_BYTES, "right")))
        low, high = int(starts[first]), int(ends[last - 1])
        power, inverse = _powers(max(20, (high - low).bit_length()))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * power[: high - low], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        first = last
    return out


@dataclass
class Texts:
    """Texts of some rows: their bytes one after the other, text i at bounds[i]:bounds[i + 1]. NULL is empty."""

    data: np.ndarray
    bounds: np.ndarray

    @property
    def count(self) -> int:
        return len(self.bounds) - 1

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first) of the maximal runs of bytes that `member` holds, never across texts; text i
        has the runs first[i]:first[i + 1]."""
        inside = member[self.data]
        size = len(inside)
        edge = np.zeros(size + 1, bool)
        edge[self.bounds] = True
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)


def texts_of(column: pa.Array) -> Texts:
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = filled.buffers()
    if data is None or not len(filled):
        return Texts(np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64))
    bounds = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    return Texts(np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0])


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut to about `BLOCK_BYTES` of text each, with their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        filled = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(filled, filled[first] + BLOCK_BYTES, "right")) - 1)
            part = batch.slice(first, last - first)
            yield part, texts_of(part.column(text))
            first = last


def ngrams(words: np.ndarray, first: np.ndarray, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n consecutive words from each place, and where each text's begin.

    `words` are word hashes, text i at first[i]:first[i + 1]. With `short`, a text of 1 to n - 1 words has its
    whole sequence as its one n-gram; otherwise it has none.
    """
    counts = np.diff(first)
    sizes = np.maximum(counts - n + 1, 0)
    begins = np.concatenate([[0], np.cumsum(np.where((sizes == 0) & (counts > 0) & short, 1, sizes))])
    out = np.empty(begins[-1], np.uint64)
    full = sizes > 0
    place = np.arange(sizes.sum()) + np.repeat(first[:-1][full] - np.cumsum(sizes[full]) + sizes[full], sizes[full])
    out[np.arange(len(place)) + np.repeat(begins[:-1][full] - np.cumsum(sizes[full]) + sizes[full], sizes[full])] = _joined(words, place, n)
    if short:
        for length in range(1, n):
            some = np.flatnonzero(counts == length)
            out[begins[:-1][some]] = _joined(words, first[:-1][some], length)
    return out, begins


def _joined(words: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    total = np.full(len(place), n, np.uint64)
    for k in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[place + k]
    return mix(total)


def chars(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


def list_column(values: np.ndarray, begins: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values, kind))
