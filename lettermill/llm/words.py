"""Words of Arrow text columns as flat numpy arrays, for code inside Spark tasks.

A batch is cut into slices of bounded text, so memory follows the longest
document rather than the batch. Null texts are empty. Words are runs of bytes
other than space and 0x09-0x0D; hashes are 64-bit and equal on all machines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Anything but ASCII letters, digits and bytes of other scripts separates words.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = PUNCTUATION[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_UNBASE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 256, np.uint64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@dataclass(frozen=True)
class Words:
    """Words of some documents: byte ranges in ``data``; document i has words first[i]:first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the rows' bounds in it."""
    binary = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, np.int64)[binary.offset : binary.offset + len(binary) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece has about ``size`` bytes of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def split_words(column: pa.Array, lower: bool = False, separators: np.ndarray = _SPACE) -> Words:
    data, bounds = text_bytes(column)
    if lower:
        data = _LOWER[data]
    word = ~separators[data]
    fresh = np.zeros(len(data) + 1, bool)  # a document begins here
    fresh[bounds] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = True, True
        before[1:] = ~word[:-1]
        after[:-1] = ~word[1:]
    starts = np.flatnonzero(word & (before | fresh[:-1]))
    ends = np.flatnonzero(word & (after | fresh[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; different values stay different."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: Words) -> np.ndarray:
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(words.data) + 1)
    return _range_sums(_CODES[words.data], words.starts, words.ends, up, down)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``hashes[starts:ends]``; equal for equal sequences."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(hashes) + 1)
    return _range_sums(hashes, starts, ends, up, down)


def _range_sums(values, starts, ends, up, down) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])
