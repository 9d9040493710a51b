"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Every vector component x becomes the integer floor(scale * x). The index is
cut into blocks. In a block each non-zero component is a posting (row,
dimension), quantised by size: level l holds those with l * step <= |x| <
(l + 1) * step, and their impact is the middle of the level, with its sign.
Postings of one dimension, level and sign form a segment, a plain list of
rows. Segments are taken by descending level, whatever their dimension; each
adds query component times impact to the accumulators of its rows only, and
takes the query component's size off what these rows can still gain.

After any segment the true score of a row lies within a slack of its
accumulator: half a level for each dimension it has been given, and the
largest component still to come for each other, times |q_d|. Impacts and
integer components are halves of integers below 2**53 in all sums, so the
accumulators carry no rounding error. A row whose upper bound is below the
k-th largest lower bound is proven out. A query stops only when the rows not
proven out are few enough to be rescored, or when the segments are used up;
all of those rows are then rescored with the integer components, so the
result is exact whatever the data is.

``step`` follows the block's own components (its 99th percentile of sizes
spans half of ``LEVELS`` levels, ``step`` at least), and the few rows with a
component beyond the last level are kept out of the postings: they, and all
rows for queries whose sums could pass 2**52, are scored as doubles, rows that
the rounding bound of the sums proves out are dropped, and the others are
rescored with integers of any size. Integer components are carried as doubles,
which hold them exactly.

On Spark: rows are dealt to blocks by their place in the written table, so
repeated rows spread; every block gets all queries (a stated query set against
all rows, in blocks), in one task that builds the block's index once and
streams the queries through it. Each block returns at most k rows a query, and
the k best per query are taken with a partial aggregate.

Defined cases: vectors that are NULL or empty, hold a NULL, NaN or infinite
component, or lack an id take no part; vectors of unequal length count as
padded with zeros; ties go to the smaller id; ``query_id`` is no candidate of
its own, in whatever row it stands; fewer candidates than k give all; a score
among the k best that a long cannot hold is an error, as in the SQL. A
repeated row is a candidate for each time it occurs, except that a query asked
twice is answered once.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut


LEVELS = 256
_EXACT = float(1 << 52)
_LONG, _DECIMAL = (1 << 63) - 1, 10**38 - 1


def _longest(lists: pa.ListArray) -> int:
    return int(np.diff(lists.offsets.to_numpy()).max(initial=0))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    rows = np.repeat(np.arange(len(lists)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


class ImpactIndex:
    """Posting segments of one block of integer vectors, by descending impact.

    ``checks``: how often, over all postings, queries are looked at for a proof.
    """

    def __init__(self, vectors: np.ndarray, step: int, checks: int = 12):
        self.vectors, self.step = vectors, step
        rows, dims = np.nonzero(vectors)
        values = vectors[rows, dims]
        level = (np.abs(values) // step).astype(np.int64)
        order = np.lexsort((rows, values > 0, dims, -level))
        rows, dims, level, up = rows[order], dims[order], level[order], (values > 0)[order]
        new = np.ones(len(rows), bool)
        new[1:] = (level[1:] != level[:-1]) | (dims[1:] != dims[:-1]) | (up[1:] != up[:-1])
        starts = np.flatnonzero(new)
        self.rows, self.ends = rows, np.append(starts[1:], len(rows))
        self.starts, self.dims, self.levels = starts, dims[starts], level[starts]
        self.impacts = np.where(up[starts], 1.0, -1.0) * (self.levels * step + (step - 1) / 2)
        # looked at behind the segments where another share of the postings is done, and at the end
        shares = np.searchsorted(self.ends, np.linspace(0, len(rows), checks + 1)[1:])
        self.looks = {int(min(x, len(starts) - 1)) for x in shares} if len(starts) else set()

    def survivors(self, queries: np.ndarray, k: int, few: int) -> list[np.ndarray]:
        """Per query the rows that can be among its k best, and maybe a few more.

        ``used`` counts the postings that were added for these queries.
        """
        n, self.used = len(self.vectors), 0
        if n <= max(few, k) or not len(self.starts):
            return [np.arange(n)] * len(queries)
        out: list = [None] * len(queries)
        open_ = np.arange(len(queries))
        weights = np.ascontiguousarray(queries.T, dtype=np.float64)  # by dimension
        sizes = np.abs(weights)
        whole = sizes.sum(0)
        scores, left = np.zeros((n, len(queries))), np.tile(whole, (n, 1))
        for at in range(len(self.starts)):
            rows, dim = self.rows[self.starts[at] : self.ends[at]], self.dims[at]
            scores[rows] += self.impacts[at] * weights[dim]
            left[rows] -= sizes[dim]
            self.used += len(rows) * len(open_)
            if at not in self.looks:
                continue
            last = at == len(self.starts) - 1
            to_come = 0 if last else (self.levels[at + 1] + 1) * self.step - 1
            slack = to_come * left + (self.step - 1) / 2 * (whole - left)
            bar = np.partition(scores - slack, n - k, axis=0)[n - k]
            may = scores + slack >= bar
            done = (may.sum(0) <= few) | last
            for i in np.flatnonzero(done):
                out[open_[i]] = np.flatnonzero(may[:, i])
            if done.any():
                go = ~done
                open_, scores, left, whole = open_[go], scores[:, go], left[:, go], whole[go]
                weights, sizes = np.ascontiguousarray(weights[:, go]), np.ascontiguousarray(sizes[:, go])
                if not len(open_):
                    break
        return out

    def top(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, few: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and exact scores of its k best rows, without those of its own id."""
        order = np.argsort(ids, kind="stable")
        first, last = (np.searchsorted(ids, own, side, sorter=order) for side in ("left", "right"))
        extra = int((last - first).max()) if len(own) else 0
        found = []
        for rows, query, query_id in zip(self.survivors(queries, min(k + extra, len(ids)), few), queries, own):
            rows = rows[ids[rows] != query_id]
            score = self.vectors[rows] @ query
            best = np.lexsort((ids[rows], -score))[:k]
            found.append((ids[rows][best], score[best]))
        return found


def _exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of integers that are held as doubles, as Python integers."""
    whole = [int(x) for x in query.tolist()]
    out = np.empty(len(vectors), object)
    out[:] = [sum(int(x) * y for x, y in zip(row, whole)) for row in vectors.tolist()]
    return out


def _wide_top(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """What :meth:`ImpactIndex.top` gives, for components of any size."""
    found = []
    for query, query_id in zip(queries, own):
        rows = np.flatnonzero(ids != query_id)
        if len(rows) > k:
            with np.errstate(over="ignore", invalid="ignore"):
                score, size = vectors[rows] @ query, np.abs(vectors[rows]) @ np.abs(query)
                error = size * (len(query) + 4) * 2.0**-52
                least = np.nan_to_num(score - error, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                rows = rows[~(score + error < np.partition(least, len(rows) - k)[len(rows) - k])]
        score = _exact_scores(vectors[rows], query)
        best = sorted(range(len(rows)), key=lambda i: (-score[i], ids[rows[i]]))[:k]  # noqa: B023
        found.append((ids[rows[best]], score[best]))
    return found


class _Block:
    """One block: the index of its rows, and the rows too large for it."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, step: int):
        sizes = np.abs(vectors)
        held = sizes[sizes > 0]
        typical = float(np.quantile(held, 0.99)) if len(held) else 0.0
        self.step = int(max(step, -(-2 * typical // LEVELS))) if typical < _EXACT else step
        beyond = sizes.max(1) >= LEVELS * self.step if len(vectors) else np.zeros(0, bool)
        self.vectors, self.ids = vectors, ids
        self.inside, self.beyond = np.flatnonzero(~beyond), np.flatnonzero(beyond)
        self.index = ImpactIndex(vectors[self.inside].astype(np.int64), self.step)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int, few: int):
        """Per query the ids and exact scores of at least its k best rows of either part."""
        fits = 4 * np.abs(queries).sum(1) * LEVELS * self.step < _EXACT
        out: list = [None] * len(queries)
        exact = self.index.top(queries[fits].astype(np.int64), self.ids[self.inside], own[fits], k, few)
        beyond = _wide_top(self.vectors[self.beyond], queries[fits], self.ids[self.beyond], own[fits], k)
        for at, parts in zip(np.flatnonzero(fits), zip(exact, beyond)):
            out[at] = [p for p in parts if len(p[0])]
        large = np.flatnonzero(~fits)
        for at, part in zip(large, _wide_top(self.vectors, queries[large], self.ids, own[large], k)):
            out[at] = [part]
        return out


def _searcher(k: int, step: int, few: int, together: int):
    """Streams (block, query, id, v) rows, a block's own rows before its queries."""

    def search(batches):
        number, rows, block = None, [], None
        width = 0

        def answers(part):
            ids, lists = part.column("id").to_numpy(), part.column("v")
            queries = _matrix(lists, max(width, _longest(lists)))
            vectors = block.vectors
            if queries.shape[1] > vectors.shape[1]:  # shorter rows count as padded with zeros
                queries = queries[:, : vectors.shape[1]]
            out = {"query_id": [], "vec_id": [], "score": []}
            for lo in range(0, len(ids), together):
                own = ids[lo : lo + together]
                for query_id, parts in zip(own, block.top(queries[lo : lo + together], own, k, few)):
                    for found, score in parts:
                        out["query_id"] += [int(query_id)] * len(found)
                        out["vec_id"] += found.tolist()
                        out["score"] += [Decimal(max(-_DECIMAL, min(_DECIMAL, int(x)))) for x in score]  # what is cut here fits no long
            kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.decimal128(38, 0)}
            return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in kinds.items()], names=list(kinds))

        for batch in batches:
            blocks, asked = batch.column("block").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (asked[1:] != asked[:-1])]))
            for lo, hi in zip(edges, np.append(edges[1:], len(blocks))):
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != number:
                    number, rows, block = blocks[lo], [], None
                if not asked[lo]:
                    rows.append(part)
                    continue
                if not rows and block is None:
                    continue  # a block without rows of its own
                if block is None:
                    width = max(_longest(r.column("v")) for r in rows)
                    vectors = np.concatenate([_matrix(r.column("v"), width) for r in rows])
                    block, rows = _Block(vectors, np.concatenate([r.column("id").to_numpy() for r in rows]), step), []
                yield answers(part)

    return search


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v): valid vectors as arrays of floor(scale * x), which are doubles."""
    v = F.col(vector_column).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(id_column).isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(good)
    exact = float(1 << 53)  # doubles from here on are integers
    whole = lambda y: F.when(F.abs(y) < exact, F.floor(y).cast("double")).otherwise(y)
    return rows.select(F.col(id_column).cast("long").alias("id"), F.transform(v, lambda x: whole(x * F.lit(float(scale)))).alias("v"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 32,
    step: int = 4,
    few: int = 64,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows where ``is_query`` (on ``id``) holds.

    ``block_rows``: rows a task holds as one index. ``query_rows``: queries that
    go through its segments together. ``few``: how many rows left
    are rescored rather than narrowed further.
    """
    rows = cut(integer_vectors(vectors, id_column, vector_column, scale), "impact_vectors")
    asked = rows.filter(is_query).dropDuplicates(["id"])
    blocks = max(1, -(-rows.count() // block_rows))
    place = F.pmod(F.xxhash64("_metadata.file_name", "_metadata.row_index"), F.lit(blocks)).cast("int")
    index = rows.select(place.alias("block"), F.lit(False).alias("asked"), "id", "v")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = asked.select(each.alias("block"), F.lit(True).alias("asked"), "id", "v")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = index.unionByName(queries).repartition(min(parts, blocks), "block").sortWithinPartitions("block", "asked")
    found = met.mapInArrow(_searcher(k, step, few, query_rows), "query_id long, vec_id long, score decimal(38,0)")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    ranked = found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
    fits = F.abs("score") <= F.lit(Decimal(_LONG))
    score = F.when(fits, F.col("score").cast("long")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
