"""Vectorised word splitting and hashing over the raw bytes of Arrow text columns.

All functions work on one slice of a batch at a time, so memory is bounded by the slice size and by the longest
single text.  Words are ``[^\\x20\\x09-\\x0D]+``; a null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

#: Two hash bases (any odd numbers do); the second serves where two independent hashes are wanted.
_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD1342543DE82EF95))
_BASE = _BASES[0]
_STEPS = {"up": _BASES[0], "down": np.uint64(pow(int(_BASES[0]), -1, 1 << 64)),
          "up2": _BASES[1], "down2": np.uint64(pow(int(_BASES[1]), -1, 1 << 64))}
_powers = {kind: np.ones(1, np.uint64) for kind in _STEPS}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of a hash base or of its inverse, kept between calls."""
    have = _powers[kind]
    if len(have) < n:
        out = np.full(-(-n // (1 << 18)) << 18, _STEPS[kind], np.uint64)
        out[0] = 1
        _powers[kind] = have = np.multiply.accumulate(out)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive rows: byte ranges in ``data`` and the bounds of each row's words."""

    first_row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    text_bounds: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        """Row of each word, counted from ``first_row``."""
        return np.repeat(np.arange(self.n_rows), self.counts)

    def hashes(self, second: bool = False) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, second)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges that depend on the bytes only: prefix sums of powers, shifted back to position 0.

    ``second`` takes another base, which gives hashes independent of the first ones.
    """
    n, tail = len(data), "2" if second else ""
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up" + tail, n), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _power("down" + tail, n + 1)[starts] + (ends - starts).astype(np.uint64))


def text_slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of slices of an Arrow string column with at most ``limit`` bytes, or one row."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_string()).fill_null("")
    if not len(array):
        return
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    values = array.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(array):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, len(array))
        yield low, data[offsets[low]:offsets[high]], (offsets[low:high + 1] - offsets[low]).astype(np.int64)
        low = high


def split_words(column, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a column, slice by slice; ``lower`` maps A-Z to a-z first."""
    for first, data, offsets in text_slices(column, limit):
        if lower:
            data = _LOWER[data]
        solid = ~_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        inner = offsets[(offsets < len(data))]
        before[inner] = False
        after = np.zeros(len(data), bool)
        after[:-1] = solid[1:]
        tails = offsets[offsets > 0] - 1
        after[tails] = False
        starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        yield Words(first, data, starts, ends, np.searchsorted(starts, offsets), offsets)


def windows(values: np.ndarray, bounds: np.ndarray, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive values within rows, and the bounds of each row's windows.

    A row with fewer values than ``size`` has no window.
    """
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    out_bounds = np.concatenate(([0], np.cumsum(counts)))
    start = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    if size > 8:  # prefix sums of powers, shifted back: the cost does not grow with the size
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power("up", len(values)), out=prefix[1:])
        return mix((prefix[start + size] - prefix[start]) * _power("down", len(values) + 1)[start] + np.uint64(seed)), out_bounds
    total = np.full(len(start), seed, np.uint64)
    for k in range(size):
        total = total * _BASE + values[start + k]
    return mix(total), out_bounds


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def unit(hashes: np.ndarray) -> np.ndarray:
    """Hashes as numbers in the open interval from 0 to 1."""
    return ((hashes >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of a slice joined by single spaces, and where each starts (one past the last word's space at the end)."""
    sizes = words.ends - words.starts
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    out = np.full(starts[-1], 0x20, np.uint8)
    out[ragged(starts[:-1], sizes)] = words.data[ragged(words.starts, sizes)]
    return out, starts
