"""Homomorphic multiset fingerprints of documents, in Spark functions only.

A document is the multiset of its paragraphs (``PARAGRAPH``: pieces between
line breaks or behind the end of a sentence; empty pieces do not count). Each
paragraph is hashed with ``SEEDS`` different seeds, 64 bits each, to a wide vector:

* ``NARROW`` words of three 20-bit lanes; a lane is one bit of a hash, 252 in all;
* ``SEEDS`` wide words of 60 bits, one of each hash.

The fingerprint is the sum of the vectors, lane by lane modulo 2**20, wide
words modulo 2**60, and the number of paragraphs. So order does not matter,
and adding or taking away a paragraph (or a whole document) adds or subtracts
its vector: :func:`combine` and :func:`remove`. Two paragraphs have the same
vector only if all four hashes agree; different multisets agree only by a
collision of all lanes.

Likeness of two fingerprints: with lanes as sums of +1 and -1, the scalar
product of two fingerprints estimates that of the multisets, so
2 <a, b> / (<a, a> + <b, b>), cut to 0 .. 1, estimates how many paragraphs are
shared; 1 for equal fingerprints. The standard error is about 1 / sqrt(252) =
0.063 for texts of distinct paragraphs. A text of more than 2**19 paragraphs
wraps its lanes: equality still holds, its likeness to others means nothing.

Everything is DataFrame code: no Python workers. The text moves once, to the
group of ``2 ** group_bits`` neighbouring ids in which the next document is
found; the first document of a group is copied to the group before it.

Defined cases: a NULL text is empty and has the fingerprint of the empty
multiset; rows with a NULL id have no place in the order and are left out;
rows that repeat an id are ordered by text; a single document is followed by
itself. Rows that share an id, and the ids of one group, are one task's window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut

PARAGRAPH = r"\n+|(?<=[.!?])[ \t\r]+"
SEEDS = 4
EACH = 21  # narrow words of one hash
NARROW, WIDE = SEEDS * EACH, SEEDS
LANES = (0, 21, 42)  # where the lanes of a narrow word begin
ROOM = 1 << 20  # of a lane; the bit above it takes a borrow
_ONE = sum(1 << at for at in LANES)
_LANE = sum((ROOM - 1) << at for at in LANES)
_SIXTY = (1 << 60) - 1


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated once a row, however often it is used.

    A generator of one row: projections on either side are not merged through
    it, so ``value`` is not repeated into each of its uses.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def paragraph_hashes(text: str) -> Column:
    """``SEEDS`` 64-bit hashes of each paragraph of a text column; the seed is hashed before the paragraph."""
    pieces = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), PARAGRAPH), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(*[F.xxhash64(F.lit(k), p).alias(f"h{k}") for k in range(SEEDS)]))


def fingerprint(hashes: str) -> Column:
    """Array of longs from a column of paragraph hashes: narrow words, wide words, number of paragraphs."""
    total = "aggregate({h}, 0L, (t, x) -> (t + ({vector})) & {mask}L)"
    narrow = [total.format(h=hashes, vector=f"shiftrightunsigned(x.h{s}, {k}) & {_ONE}L", mask=_LANE) for s in range(SEEDS) for k in range(EACH)]
    wide = [total.format(h=hashes, vector=f"x.h{s} & {_SIXTY}L", mask=_SIXTY) for s in range(SEEDS)]
    return F.expr(f"array({', '.join(narrow + wide)}, cast(size({hashes}) as bigint))")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of its ``text`` column as column ``name``."""
    return _once(df, f"{name}_hashes", paragraph_hashes(text)).withColumn(name, fingerprint(f"{name}_hashes")).drop(f"{name}_hashes")


def _masked(a: str, b: str, operation: str) -> Column:
    masks = [f"{_LANE}L"] * NARROW + [f"{_SIXTY}L"] * WIDE + [f"{(1 << 62) - 1}L"]
    guard = [f"{_LANE + _ONE}L"] * NARROW + [f"{_SIXTY + 1}L"] * WIDE + ["0L"]  # what a lane may borrow
    ready = f"zip_with({a}, array({', '.join(guard)}), (x, g) -> {'x + g' if operation == '-' else 'x'})"
    return F.expr(f"zip_with(zip_with({ready}, {b}, (x, y) -> x {operation} y), array({', '.join(masks)}), (x, m) -> x & m)")


def combine(a: str, b: str) -> Column:
    """Fingerprint of the sum of two multisets, given by fingerprint columns."""
    return _masked(a, b, "+")


def remove(a: str, b: str) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b`` (which it has to hold)."""
    return _masked(a, b, "-")


def as_text(words: str) -> Column:
    return F.expr(f"lower(array_join(transform({words}, x -> lpad(hex(x), 16, '0')), ''))")


def lanes(words: str) -> Column:
    """The narrow words of a fingerprint column as signed sums of +1 and -1."""
    signed = ", ".join(f"pmod((shiftrightunsigned(w, {at}) & {ROOM - 1}L) * 2 - element_at({words}, -1) + {ROOM // 2}L, {ROOM}L) - {ROOM // 2}L" for at in LANES)
    return F.expr(f"flatten(transform(slice({words}, 1, {NARROW}), w -> array({signed})))")


def likeness(a: str, b: str) -> Column:
    """Likeness, 0 to 1, of two fingerprint columns whose lanes are columns ``<name>_lanes``."""
    product = "aggregate(zip_with({p}_lanes, {q}_lanes, (x, y) -> x * y), 0L, (t, v) -> t + v)"
    norm = f"({product.format(p=a, q=a)} + {product.format(p=b, q=b)})"
    share = f"least(1.0D, greatest(0.0D, cast(2 * {product.format(p=a, q=b)} as double) / {norm}))"
    return F.expr(f"case when {a} = {b} then 1.0D when {norm} = 0 then 0.0D else {share} end")


def with_next(docs: DataFrame, ids: DataFrame, columns: list[str], group_bits: int = 10) -> DataFrame:
    """``docs`` with ``next_<c>`` of the document that follows by ``doc_id`` (after the last: the first).

    ``ids`` holds the same ``doc_id`` (a narrow scan, where ``docs`` computes
    columns). Groups are runs of ids, so none is larger than its range. The table
    of groups has one small row per group; it is looked up by the first id of
    a group, with a join that Spark broadcasts only if the table is small.
    """
    group = F.shiftright("doc_id", group_bits)
    firsts = ids.select("doc_id", group.alias("grp")).groupBy("grp").agg(F.min("doc_id").alias("doc_id"))
    # the group before each: within ranges of groups, and by one row a range across them
    ranged = cut(firsts.repartitionByRange("grp").withColumn("range", F.spark_partition_id()), "group_firsts")
    ends = ranged.groupBy("range").agg(F.max("grp").alias("end"))
    order = Window.orderBy("range")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("range", F.coalesce(F.lag("end").over(order), F.last("end").over(whole)).alias("end_before"))
    inside = F.lag("grp").over(Window.partitionBy("range").orderBy("grp"))
    before = ranged.withColumn("inside", inside).join(ends, "range").select("doc_id", F.coalesce("inside", "end_before").alias("also"))
    placed = docs.join(before, "doc_id", "left").withColumn("grp", group)
    own = F.struct(F.col("grp").alias("grp"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("also").alias("grp"), F.lit(1).alias("guest"))
    placed = placed.select("doc_id", *columns, F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("at"))
    place = Window.partitionBy("at.grp").orderBy("at.guest", "doc_id", *columns[:1])
    found = placed.select("doc_id", *columns, "at.guest", *[F.lead(c).over(place).alias(f"next_{c}") for c in columns])
    return found.filter("guest = 0").drop("guest")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likeness.

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many of the next document. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("doc_id is not null")
    ids = docs.select("doc_id")
    docs = with_fingerprint(docs, "text", "words")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_next(docs, ids, ["text", "words"]).select("doc_id", n.cast("long").alias("n_chars"), "words", "next_words", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_words")
    for name in ("words", "edited_words", "next_words"):
        rows = _once(rows, f"{name}_lanes", lanes(name))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        as_text("words").alias("fingerprint"), as_text("edited_words").alias("edited_fingerprint"),
        likeness("words", "edited_words").alias("near_edited"), likeness("words", "next_words").alias("near_next"),
    )
