"""Pairs of similar sets in different parts, by prefixes of rare elements.

Two sets of sizes n and m whose Jaccard similarity is t or more share at least
t / (1 + t) * (n + m) elements. Put the elements of all sets in one order:
then the first common element of such a pair has so few elements before it in
either set that enough are left, so sets need to meet on their first elements
only. With rare elements first, near copies that each hold elements of their
own meet nobody there, however many share the rest.

* The order is by frequency class (1, 2, 4, 16, 64 sets and more, as a count-min
  sketch estimates them) and then by hash. Any order is right, so estimates do
  for it. An element estimated to stand in one set is in no other: it takes its
  place in the order and is not emitted.
* An element at place p of a set of n bounds the partner's size by
  (1 + t) / t * (n - p) - n, and sizes differ by the factor t at most. Rows of
  both sides meet by element and size band within these bounds.
* Each set has a bitmap of 1024 hash classes. A class that one set has and the
  other lacks holds an element that they do not share, so the bitmaps bound
  their intersection as well; near copies that differ in too many places drop
  out in the join.
* Sets of one part need not meet. Of each element the part with most of its rows
  (a large group of copies) is only met, it does not ask; so the work is that
  of the rows outside of it.

No pair at t or above is lost; what is returned must still be tested in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import sketch as S
from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import cut

CLASSES = (2, 4, 16, 64)
MAP_BITS = 1024
_BAND = np.log(1.03)
_SCHEMA = "shingle long, node long, part long, n int, least int, most int, map array<long>"


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements and the sizes of the lists."""
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return lists.flatten().to_numpy().view(np.uint64), sizes


def _counter(bits: int):
    def count(batches):
        sketch = S.Counter(bits, 1)
        for batch in batches:
            yield from sketch.add(_flat(batch.column(0))[0].copy())
        yield from sketch.batches()
        X.release_memory()

    return count


def _prefixes(bits: int, held, percent: int):
    def emit(batches):
        planes = held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                elements, sizes = _flat(part.column(2))
                row = np.repeat(np.arange(len(sizes)), sizes)
                kind = sum(S.passes(plane, elements, bits).astype(np.int8) for plane in planes)
                mixed = X.mix(elements)
                order = np.lexsort((mixed, kind, row))
                elements, kind = elements[order], kind[order]
                n = sizes[row]
                place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                least = -(-percent * n // 100)
                most = np.minimum((100 + percent) * (n - place) // percent - n, 100 * n // percent)
                use = np.flatnonzero((kind > 0) & (most >= least))
                at = pa.array(row[use])
                held_classes = np.zeros((len(sizes), MAP_BITS), bool)
                held_classes[row, (X.mix(elements) % np.uint64(MAP_BITS)).astype(np.int64)] = True
                maps = np.packbits(held_classes, axis=1).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * maps.shape[1], maps.ravel())
                columns = [pa.array(elements[use].view(np.int64)), part.column(0).take(at), part.column(1).take(at), *(pa.array(x[use].astype(np.int32)) for x in (n, least, most)), lists.take(at)]
                yield pa.RecordBatch.from_arrays(columns, names=["shingle", "node", "part", "n", "least", "most", "map"])
        X.release_memory()

    return emit


def _maps_allow(percent: int) -> str:
    """Condition that the sets may share enough, by the classes that one has and the other lacks."""
    apart = lambda x, y: " + ".join(f"bit_count(map_{x}[{k}] & ~map_{y}[{k}])" for k in range(MAP_BITS // 64))
    enough = lambda x, y: f"{100 + percent} * (n_{x} - ({apart(x, y)})) >= {percent} * (n_u + n_v)"
    return f"{enough('u', 'v')} and {enough('v', 'u')}"


def candidate_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v), u > v: all pairs of nodes in different parts whose sets may reach ``percent``.

    ``sets``: node, part, shingles (distinct 64-bit hashes). A node may have
    several sets.
    """
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.size("shingles").cast("long"))).first()[0] or 0
    bits = S.bits_for(total, spare=2)
    counted = sets.select("shingles").mapInArrow(_counter(bits), S.SCHEMA)
    held = spark.sparkContext.broadcast([plane for plane in S.planes(counted, bits, 1, CLASSES)])
    rows = cut(sets.select("node", "part", "shingles").mapInArrow(_prefixes(bits, held, percent), _SCHEMA), "prefixes")
    of_part = rows.groupBy("shingle", "part").agg(F.count(F.lit(1)).alias("c"))
    shared = of_part.groupBy("shingle").agg(F.max(F.struct("c", "part")).alias("top"), F.min("part").alias("lo"), F.max("part").alias("hi"))
    shared = cut(shared.filter("lo < hi").select("shingle", F.col("top.part").alias("top")), "shared_prefixes")
    band = lambda c: F.floor(F.log(c) / F.lit(float(_BAND))).cast("int")
    asking = rows.join(shared, "shingle").filter("part <> top")
    asking = asking.select("shingle", *[F.col(c).alias(f"{c}_u") for c in ("node", "part", "n", "least", "most", "map")], F.explode(F.sequence(band("least"), band("most"))).alias("band"))
    met = rows.select("shingle", *[F.col(c).alias(f"{c}_v") for c in ("node", "part", "n", "least", "most", "map")], band("n").alias("band"))
    fits = "part_u <> part_v and n_v between least_u and most_u and n_u between least_v and most_v and " + _maps_allow(percent)
    pairs = asking.join(met, ["shingle", "band"]).filter(fits)
    return pairs.select(F.greatest("node_u", "node_v").alias("u"), F.least("node_u", "node_v").alias("v")).filter("u <> v").distinct()
