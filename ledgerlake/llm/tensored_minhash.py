"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of ``words`` words (lower-cased
A-Z, words split at ASCII white space): two by the contract of op10, five in
:func:`deduplicated`. Two collections of ``keys`` short keys, each over
``rows`` minhashes, are made per document; every pair (one key from either
collection) is a table key. So 2 * keys * rows minhashes serve keys ** 2
tables of 2 * rows minhashes each: the tables cost the square of what is
computed. Two sets of similarity s share a table key with probability
(1 - (1 - s**rows)**keys) ** 2; with the defaults a pair at exactly 0.8 is
missed with probability 2e-5, a pair at 0.85 with 5e-7.

Work flows in four steps, all of them Spark joins and aggregates:

1. documents with equal sets become one class, named by its smallest id;
2. classes that share a table key are candidates; a short key that one class
   has alone can form none that is shared, so only the others are paired up,
   which leaves out most of the tables' rows. Every class is first
   tested against a few hubs: for each of its keys, the class of the key that
   shares keys with most others (in a group of copies, the one they were made
   from). The confirmed links join most groups. All other pairs that share a
   key are tested too, but only where their two ends are not yet in one
   component, so a group of many near copies costs a number of tests near its
   size, not its square. The classes of such keys meet by an exact prefix join
   (:mod:`ledgerlake.llm.prefix_join`) rather than by key: near copies share
   keys with nearly all others of their group, but copies too far from its hub
   to be linked to it have words of their own, and these come first in the join's
   order, so they meet few. It finds every pair that reaches the similarity;
3. a test compares the two full sets (64-bit shingle hashes). Pairs whose sizes
   rule the similarity out are not tested, nor pairs whose minhashes (four bits
   of each are kept) differ in more places than six standard deviations above
   what a pair at the threshold shows, which such a pair exceeds with a
   probability of about 1e-7;
4. components of the confirmed links; the smallest id of each is kept.

Defined cases: an empty or NULL text (or one of white space only) has an empty
set, is linked with nothing and is kept; a text of fewer than ``words`` words
has one shingle, of all its words; rows that share a ``doc_id`` count as one document for links and each keeps
its own row; rows with a NULL ``doc_id`` are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import cut
from ledgerlake.llm.components import components
from ledgerlake.llm.prefix_join import candidate_pairs

_PLACES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))  # factors of the first words of a shingle
_SINGLE, _OTHER = np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63)


def _factors(words: int) -> tuple[np.uint64, ...]:
    """Odd factors, one for each place in a shingle."""
    return (*_PLACES, *(X.mix(np.arange(3, words + 1, dtype=np.uint64)) | np.uint64(1)))[:words]


def shingle_sets(column: pa.Array, words: int = 2):
    """Yield (first row, sets) for runs of whole texts; a set is the sorted
    distinct 64-bit hashes of the shingles of ``words`` words of a text."""
    factors = _factors(words)
    for at, data, offsets in X.text_slices(column):
        sets = []
        starts, ends, first = X.word_spans(data, offsets)
        each = X.span_hashes(X.prefix_sums(data), starts, ends)
        runs = max(len(each) - words + 1, 0)
        whole = np.zeros(runs, np.uint64)
        for k, factor in enumerate(factors):
            whole += each[k : k + runs] * factor
        whole = X.mix(whole)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            n = hi - lo
            if n >= words and n > 1:
                sets.append(np.unique(whole[lo : hi - words + 1]))
            elif n > 1:
                short = (each[lo:hi] * np.array(factors[:n])).sum(keepdims=True, dtype=np.uint64)
                sets.append(X.mix(short) ^ _SINGLE * np.array([n], np.uint64))
            else:
                sets.append(each[lo:hi] ^ _SINGLE)
        yield at, sets


def _sketcher(keys: int, rows: int, seed: int, words: int):
    """Function of Arrow batches: size, digest of the set, both key collections."""
    odd = np.random.default_rng(seed).integers(1, 1 << 63, 2 * keys * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = X.mix(np.arange(1, 2 * keys + 1, dtype=np.uint64))

    def group(sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        out = np.zeros((len(sets), 2 * keys), np.uint64)
        bits = np.zeros((len(sets), -(-2 * keys * rows // 16)), np.uint64)
        digest = np.zeros((len(sets), 2), np.uint64)
        if len(full):
            flat = np.concatenate([sets[i] for i in full])
            at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            digest[full, 0] = np.add.reduceat(X.mix(flat), at)
            digest[full, 1] = np.add.reduceat(X.mix(flat ^ _OTHER), at)
            held = np.empty_like(flat)
            for k in range(2 * keys):
                key = np.full(len(full), salt[k])
                for r in range(rows):
                    place = k * rows + r
                    np.multiply(flat, odd[place], out=held)
                    least = np.minimum.reduceat(held, at)
                    key = X.mix(key ^ least)
                    bits[full, place // 16] |= (X.mix(least) & np.uint64(15)) << np.uint64(4 * (place % 16))
                out[full, k] = key
        return sizes, digest.view(np.int64), out.view(np.int64), bits.view(np.int64)

    def sketch(batches):
        lists = lambda m: pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], np.ascontiguousarray(m).ravel())
        for batch in batches:
            for at, sets in shingle_sets(batch.column(1), words):
                sizes, digest, out, bits = group(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array(sizes), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists(out[:, :keys]), lists(out[:, keys:]), lists(bits)],
                    names=["doc_id", "n_shingles", "d1", "d2", "a", "b", "bits"],
                )
            del batch
        X.release_memory()

    return sketch


def _set_rows(words: int):
    def rows(batches):
        for batch in batches:
            for at, sets in shingle_sets(batch.column(1), words):
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), batch.column(2).slice(at, len(sets)), lists], names=["node", "part", "shingles"])
            del batch
        X.release_memory()

    return rows


def _possible(percent: int, minhashes: int) -> str:
    """Condition on n_u, n_v, bits_u, bits_v of pairs that can reach the similarity."""
    share = (1 - percent / 100) * 15 / 16
    most = int(minhashes * share + 6 * (minhashes * share * (1 - share)) ** 0.5)
    differ = []
    for k in range(-(-minhashes // 16)):  # nibbles that differ, counted by their lowest bit
        x = f"(bits_u[{k}] ^ bits_v[{k}])"
        y = f"({x} | shiftrightunsigned({x}, 1))"
        differ.append(f"bit_count(({y} | shiftrightunsigned({y}, 2)) & {0x1111111111111111}L)")
    return f"100 * least(n_u, n_v) >= {percent} * greatest(n_u, n_v) and {' + '.join(differ)} <= {most}"


def _as(facts: DataFrame, end: str) -> DataFrame:
    return facts.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("bits").alias(f"bits_{end}"))


def confirmed_links(docs: DataFrame, allowed: DataFrame, percent: int, words: int = 2, sets: DataFrame | None = None) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough.

    ``docs``: doc_id, text. Only texts of candidates are turned into sets,
    unless ``sets`` (node, shingles) has them. The pairs meet the sets of ``u``
    first, whose rows are the rarer to repeat; a hot ``v`` is split by the
    adaptive skew join.
    """
    allowed = cut(allowed, "pairs")
    if sets is None:
        nodes = cut(allowed.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "pair_nodes")
        texts = docs.select("doc_id", "text", F.lit(0).cast("long").alias("part")).join(nodes, "doc_id", "left_semi")
        sets = cut(texts.mapInArrow(_set_rows(words), "node long, part long, shingles array<long>"), "pair_sets")
    first = allowed.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("s_u")), "u")
    both = first.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("s_v")), "v")
    common = both.select("u", "v", F.size("s_u").alias("n_u"), F.size("s_v").alias("n_v"), F.size(F.array_intersect("s_u", "s_v")).alias("common"))
    return common.filter(f"100L * common >= {percent} * (n_u + n_v - common)").select("u", "v").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, keys: int = 16, rows: int = 3, seed: int = 10, hubs_tested: int = 4, words: int = 2) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs ``doc_id`` and ``text``. See the module text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    sketches = cut(
        docs.mapInArrow(_sketcher(keys, rows, seed, words), "doc_id long, n_shingles long, d1 long, d2 long, a array<long>, b array<long>, bits array<long>"),
        "sketches",
    )
    full = sketches.filter("n_shingles > 0")
    classes = cut(full.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node")), "classes")
    named = classes.select(F.col("node").alias("doc_id"), "d1", "d2", "n_shingles")
    reps = full.join(named, ["doc_id", "d1", "d2", "n_shingles"], "left_semi")

    # Table keys of pairs of short keys that several classes have, and of those table keys the same.
    short = [_members(reps.select(F.explode(side).alias("key"), F.col("doc_id").alias("node"))).withColumnRenamed("key", side) for side in "ab"]
    tables = short[0].join(short[1], "node").select(F.xxhash64("a", "b").alias("key"), "node")
    shared = cut(_members(tables), "shared_keys")
    facts = reps.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bits")
    possible = F.expr(_possible(percent, 2 * keys * rows))
    hubs = _hub_pairs(shared, hubs_tested)
    first = hubs.join(_as(facts, "u"), "u").join(_as(facts, "v"), "v").filter(possible).select("u", "v").distinct()
    links = cut(confirmed_links(docs, first, percent, words), "confirmed")
    labels = cut(components(links), "labels")

    # Pairs that have not been tested and lie in two components, among the classes of keys that have two.
    label = shared.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    open_keys = label.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("key")
    members = cut(label.join(open_keys, "key", "left_semi").select(F.col("node").alias("doc_id"), "part").distinct(), "open_members")
    sets = cut(docs.join(members, "doc_id").select("doc_id", "text", "part").mapInArrow(_set_rows(words), "node long, part long, shingles array<long>"), "open_sets")
    tested = hubs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    rest = cut(candidate_pairs(sets, percent), "met_pairs").join(tested, ["u", "v"], "left_anti")
    rest = rest.join(_as(facts, "u"), "u").join(_as(facts, "v"), "v").filter(possible).select("u", "v").distinct()
    more = cut(confirmed_links(docs, rest, percent, words, sets), "confirmed_more")
    if more.take(1):
        labels = components(links.unionByName(more))

    of_class = classes.join(labels, "node", "left").select("d1", "d2", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    of_class = cut(of_class, "class_labels")
    out = sketches.select("doc_id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2", "n_shingles"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def _members(keys: DataFrame) -> DataFrame:
    """Rows (key, node) of the keys that several classes have."""
    several = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    return keys.join(several, "key", "left_semi")


def _hub_pairs(shared: DataFrame, most: int) -> DataFrame:
    """Pairs (u, v) of each class and up to ``most`` of the hubs of its keys (other pairs follow later)."""
    counts = shared.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weights = shared.join(counts, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    heaviest = F.max(F.struct("weight", (-F.col("node")).alias("node")))
    hubs = cut(shared.join(weights, "node").groupBy("key").agg(heaviest.alias("hub")).select("key", "hub.weight", (-F.col("hub.node")).alias("v")), "hubs")
    met = shared.select("key", F.col("node").alias("u")).join(hubs, "key").filter("u <> v")
    met = met.groupBy("u", "v").agg(F.max("weight").alias("weight"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("weight"), "v"))
    return cut(met.withColumn("rank", rank).filter(F.col("rank") <= most).select("u", "v"), "hub_pairs")


def deduplicated(docs: DataFrame, words: int = 5, **options) -> DataFrame:
    """``docs`` with one document of each component of near duplicates, all columns.

    Near duplicates share 80 % of their shingles of ``words`` words (``percent``
    in ``options``). Of rows that repeat the kept id, the one with the smallest text stays.
    Only ids to drop, and ids that repeat, are joined to the texts: Spark
    broadcasts them if they are few.
    """
    docs = docs.filter("doc_id is not null")
    found = cut(near_duplicates(docs, words=words, **options).select("doc_id", "kept"), "near_duplicates")
    long_id = F.col("doc_id").cast("long")
    drop = cut(found.filter("not kept").select(F.col("doc_id").alias("_drop")).distinct(), "dropped")
    again = cut(found.filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again")), "repeated")
    left = docs.join(drop, long_id == F.col("_drop"), "left_anti")
    single = left.join(again, long_id == F.col("_again"), "left_anti")
    order = Window.partitionBy(long_id).orderBy("text")
    repeated = left.join(again, long_id == F.col("_again"), "left_semi").withColumn("_row", F.row_number().over(order)).filter("_row = 1").drop("_row")
    return single.unionByName(repeated)
