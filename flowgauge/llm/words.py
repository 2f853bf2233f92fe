"""Words of many texts at once, as NumPy arrays: spans, 64-bit hashes, hashes of word n-grams.

A word is a longest run of bytes other than space, tab, LF, VT, FF and CR, so ``[^\\x20\\x09-\\x0D]+`` over the
UTF-8 form. Hashes are polynomials modulo 2**64 read from prefix sums and then mixed; equal words and equal
n-grams have equal hashes, different ones differ but for the chance of a 64-bit collision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES, HASHED_BYTES = 4 << 20, 1 << 18
KEPT_POWERS = 1 << 20
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    size = 1 << max(16, int(n).bit_length())
    if size > KEPT_POWERS:  # rare and large: not kept by the worker
        return _powers.__wrapped__(base, size)[:n]
    return _powers(base, size)[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed hashes of values[start:end] for every pair of bounds."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(base, len(values)), dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(inverse(base), len(values) + 1)[starts])


@dataclass
class Words:
    """The words of several texts, in order. first[i]:first[i + 1] are those of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words and hashes of every n words in a row that lie in one text."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        at = np.arange(len(self.hashes))
        at = at[at + n <= last]
        return at, run_hashes(self.hashes, at, at + n, WORD_BASE)


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = SPACE[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[::2], edges[1::2]


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    data = np.frombuffer(b" ".join(texts), np.uint8)
    if lower:
        data = LOWER[data]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    starts, ends = spans(data)
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # piece by piece, so that a very long text needs little more than its own words
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED_BYTES)))
        lo, hi = starts[i], ends[j - 1]
        hashes[i:j] = run_hashes(data[lo:hi], starts[i:j] - lo, ends[i:j] - lo, BYTE_BASE)
        i = j
    return Words(data, starts, ends, np.searchsorted(starts, bounds), hashes)


def slices(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in parts of about ``limit`` bytes of text (at least one row each); null is the empty text."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    part = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo), [x or b"" for x in texts.slice(lo, hi - lo).to_pylist()]
