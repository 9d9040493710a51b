"""Numpy views of Arrow text columns: bytes, words, word hashes.

Words are the runs of bytes outside the six ASCII white-space bytes (0x20 and
0x09-0x0D). A word hash is a polynomial of the word's bytes modulo 2**64 with
a random value per byte (A-Z share the values of a-z), mixed afterwards. Work
goes through the buffer in slices of whole rows, so memory follows the slice
and the longest single text, not the Arrow batch.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 12
_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20260423).integers(1, 1 << 63, 256, dtype=np.uint64)
    values = values * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    return values


def _exact_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_VALUES = _byte_values()
EXACT_VALUES = (_exact_values(50), _exact_values(51))  # two that tell A-Z from a-z
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 .. n, modulo 2**64."""
    have = _powers.get(0)
    if have is None or len(have[0]) <= n:
        size = max(n, SLICE_BYTES) + 1
        up = np.full(size, _MULT, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size == SLICE_BYTES + 1:  # a very long text does not stay in memory
            _powers[0] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield (first row, bytes, offsets) for runs of whole rows of about ``limit`` bytes, one row at least."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + SLICE_ROWS, len(column))
        lo, hi = offsets[first], offsets[last]
        yield first, data[lo:hi], offsets[first : last + 1] - lo
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per row the index of its first word (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = separator[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = border[:-1].copy()
    before[1:] |= space[:-1]
    after = border[1:].copy()
    after[:-1] |= space[1:]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Polynomial prefix sums of the bytes; see :func:`span_hashes`."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, the same wherever the span stands."""
    _, down = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts])


def sequence_sums(hashes: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of a sequence of word hashes."""
    up, _ = powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64, out=sums[1:])
    return sums


def window_hashes(sums: np.ndarray, words: int) -> np.ndarray:
    """64-bit hash of each stretch of ``words`` items of the sequence."""
    runs = max(len(sums) - words, 0)
    _, down = powers(len(sums) - 1)
    return mix((sums[words:] - sums[:runs]) * down[:runs])


def release_memory() -> None:
    """Give freed memory back to the machine: Spark keeps idle workers alive between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
