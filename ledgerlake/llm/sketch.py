"""Count-min sketches of 64-bit hashes, made per task and merged by Spark.

A sketch has ``rows`` rows of 2**bits counters. Tasks count into sparse
sketches and emit them in slices of 2**16 counters; slices are shuffled by
their number and added up one at a time, in a stream, so neither the tasks nor
the merge hold more than a slice of the whole. Counters stop at 255. What
reaches the driver, and from there the tasks, is one bit a counter ("at least
so many"): ``rows * 2**bits / 8`` bytes, at most ``rows`` * 32 MB as
:func:`bits_for` bounds the bits at 2**28 whatever the data is.

Estimates never fall below the true count, so a filter by them loses nothing.
When there are more hashes than counters it lets more pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm import text_np as X

SLICE = 1 << 16
SCHEMA = "slice long, places binary, counts binary"
MOST_BITS = 28
_SEEDS = tuple(X.mix(np.arange(901, 909, dtype=np.uint64)))


def bits_for(items: int, spare: int = 4, least: int = 16) -> int:
    """Bits of a row with ``spare`` counters an item, between ``least`` and ``MOST_BITS``."""
    return min(max(int(max(items, 1) * spare - 1).bit_length(), least), MOST_BITS)


def places(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each hash in one row."""
    return (X.mix(hashes ^ _SEEDS[row]) >> np.uint64(64 - bits)).astype(np.int64)


class Counter:
    """The sketch of one task, given out in slices whenever ``flush`` hashes have been held."""

    def __init__(self, bits: int, rows: int, flush: int = 1 << 22):
        self.bits, self.rows, self.flush = bits, rows, flush
        self.held, self.size = [], 0

    def add(self, hashes: np.ndarray):
        self.held.append(hashes)
        self.size += len(hashes)
        if self.size >= self.flush:
            yield from self.batches()

    def batches(self):
        if not self.size:
            return
        hashes = np.concatenate(self.held)
        self.held, self.size = [], 0
        for row in range(self.rows):
            at, counts = np.unique(places(hashes, row, self.bits), return_counts=True)
            number = at // SLICE
            starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            ends = np.append(starts[1:], len(at))
            inside = (at % SLICE).astype(np.uint16)
            small = np.minimum(counts, 255).astype(np.uint8)
            slices = number[starts] + (row << self.bits) // SLICE
            yield pa.RecordBatch.from_arrays(
                [pa.array(slices), pa.array([inside[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()), pa.array([small[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                names=["slice", "places", "counts"],
            )


def _merger(thresholds: tuple[int, ...]):
    def merge(batches):
        now, total = None, None

        def done():
            planes = np.packbits(np.stack([total >= x for x in thresholds]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([planes.tobytes()], pa.binary())], names=["slice", "held"])

        for batch in batches:
            for number, at, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != now:
                    if now is not None:
                        yield done()
                    now, total = number, np.zeros(SLICE, np.int64)
                total[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.uint8)
        if now is not None:
            yield done()

    return merge


def planes(sketches: DataFrame, bits: int, rows: int, thresholds: tuple[int, ...]) -> list[np.ndarray]:
    """For each threshold (255 at most) a bit array (rows, 2**bits / 8): counters whose merged total reaches it."""
    if not 1 <= min(thresholds) <= max(thresholds) <= 255:
        raise ValueError("counters stop at 255")
    parts = int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = sketches.repartition(max(1, min(parts, rows << bits >> 16)), "slice").sortWithinPartitions("slice")
    out = np.zeros((len(thresholds), max(rows << bits, SLICE) // SLICE, SLICE // 8), np.uint8)
    for row in sliced.mapInArrow(_merger(tuple(thresholds)), "slice long, held binary").toLocalIterator():
        out[:, row["slice"]] = np.frombuffer(row["held"], np.uint8).reshape(len(thresholds), -1)
    return [plane.reshape(rows, -1) for plane in out]


def reached(sketches: DataFrame, bits: int, rows: int, least: int) -> np.ndarray:
    """The plane of one threshold."""
    return planes(sketches, bits, rows, (least,))[0]


def passes(held: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether every row's counter of a hash has reached the bound."""
    good = np.ones(len(hashes), bool)
    for row in range(len(held)):
        at = places(hashes, row, bits)
        good &= (held[row][at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return good
