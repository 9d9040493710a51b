"""Token-id store: one zstandard frame per document, with a shared dictionary.

Texts are encoded with a given public tokenizer, an end id is appended, and
the ids (little-endian, 16 bits where the vocabulary allows it, else 32) are
compressed per document with a dictionary that zstandard trains on a bounded
sample of serialized id arrays. So a short document is read alone, and still
compresses as if its neighbours were known.

File format: Parquet files of blocks, in ascending order of document id over
all files. A row is a block of ``block_docs`` documents:

* ``part``, ``block``: place of the block in the order;
* ``dictionary_sha256``: hash of the dictionary the frames need;
* ``doc_ids``: little-endian 64-bit ids, ``counts``: 64-bit id counts;
* ``offsets``: 64-bit offsets of the frames in ``frames``, one more at the end;
* ``frames``: the frames of the documents, one after the other.

The dictionary itself is a one-row Parquet file beside them, so readers check
its hash; the whole store is written by Spark's committers and readable on any
storage Spark reads.

Encoding: where a tokenizer splits at white space, a text's ids are those of
its white-space-separated pieces, one after the other. Pieces are then encoded
once per worker process (a bounded cache) and texts are assembled with numpy.
Whether a tokenizer does is read from its own normalizer, pre-tokenizer and
added tokens (:func:`splits_at_white_space`); for all others whole texts are
encoded. The dictionary is trained by one task from the bounded sample; the
driver holds the tokenizer's file and the dictionary, no encodings.

Defined cases: NULL text is empty (only the end id); rows with a NULL id are
left out; rows that repeat an id are each stored, ordered by text; an empty
table gives an empty store.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import text_np as X
from ledgerlake.llm.common import ident_hash, worker_cache

BLOCK_SCHEMA = "part int, block long, dictionary_sha256 string, doc_ids binary, counts binary, offsets binary, frames binary"


class HashPlaces:
    """Open-addressing table from non-zero 64-bit hashes to numbers, looked up by whole arrays."""

    def __init__(self, most: int):
        bits = max(10, int(most * 2 - 1).bit_length())
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 if unknown."""
        out = np.full(len(hashes), -1, np.int32)
        at = (hashes >> self.shift).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            key = self.keys[at]
            hit = key == hashes[left]
            out[left[hit]] = self.values[at[hit]]
            go = ~hit & (key != 0)
            left, at = left[go], (at[go] + 1) & self.mask
        return out

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Put in new, distinct hashes."""
        at = (hashes >> self.shift).astype(np.int64)
        while len(hashes):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]  # of several for one slot, one stays
            placed = free & (self.keys[at] == hashes)
            self.values[at[placed]] = values[placed]
            hashes, values, at = hashes[~placed], values[~placed], (at[~placed] + 1) & self.mask


class PieceEncoder:
    """Encodes texts piece by piece with a cache of at most ``most`` pieces."""

    mark = "<|endoftext|>"

    def __init__(self, tokenizer_json: str, whole: bool = False, most: int = 1 << 21):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.whole, self.most = whole or self.mark_id is None, most
        self._clear()

    def _clear(self):
        self.table = HashPlaces(self.most)
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)  # ids of piece k: starts[k] to starts[k + 1]
        self.pieces, self.used = 0, 0

    def _ids(self, texts: list[str]) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece; pieces are joined by a special token, at which encoding always splits."""
        plain = [p for p in pieces if "<|" not in p]
        out = {}
        for lo in range(0, len(plain), 512):
            part = plain[lo : lo + 512]
            ids = np.array(self._ids([self.mark.join(part)])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) != len(part) - 1:
                raise ValueError("a piece holds a special token")
            edges = np.concatenate([[-1], cuts, [len(ids)]])
            out.update(zip(part, (ids[a + 1 : b] for a, b in zip(edges[:-1], edges[1:]))))
        for p in pieces:
            if p not in out:
                out[p] = np.array(self._ids([p])[0], np.uint32)
        return [out[p] for p in pieces]

    def _learn(self, hashes: np.ndarray, pieces: list[str]):
        found = self._encode_pieces(pieces)
        lengths = np.array([len(x) for x in found], np.int64)
        new = np.concatenate(found) if found else np.zeros(0, np.uint32)
        if self.pieces + len(found) + 1 > len(self.starts):  # room for twice as many
            self.starts = np.concatenate([self.starts, np.zeros(self.pieces + len(found) + 1, np.int64)])
        if self.used + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.used + len(new), np.uint32)])
        self.ids[self.used : self.used + len(new)] = new
        self.starts[self.pieces + 1 : self.pieces + 1 + len(found)] = self.used + np.cumsum(lengths)
        self.table.add(hashes, np.arange(self.pieces, self.pieces + len(found), dtype=np.int32))
        self.pieces, self.used = self.pieces + len(found), self.used + len(new)

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Cache numbers of the pieces, after learning those that are new."""
        hashes = _exact_hashes(data, starts, ends)
        places = self.table.find(hashes)
        new = np.flatnonzero(places < 0)
        if len(new):
            unique, at = np.unique(hashes[new], return_index=True)
            if self.pieces + len(unique) > self.most:
                if self.pieces:
                    self._clear()
                    return self._places(data, starts, ends)
                self.table = HashPlaces(len(unique))  # one very long text: the table grows with it
            at = new[at]
            self._learn(unique, [data[a:b].tobytes().decode("utf-8") for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            places[new] = self.table.find(hashes[new])
        return places

    def encode(self, column: pa.Array):
        """Yield the ids (uint32 array) of each text, in order."""
        if self.whole:
            for lo in range(0, len(column), 64):
                for ids in self._ids([x or "" for x in column.slice(lo, 64).to_pylist()]):
                    yield np.array(ids, np.uint32)
            return
        for _, data, offsets in X.text_slices(column):
            starts, ends, first = X.word_spans(data, offsets)
            places = self._places(data, starts, ends)
            begin = self.starts[places]
            lengths = self.starts[places + 1] - begin
            until = np.concatenate([[0], np.cumsum(lengths)])
            ids = self.ids[np.repeat(begin - until[:-1], lengths) + np.arange(until[-1])]
            edges = until[first]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                yield ids[a:b]


_CASED = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans that tell upper from lower case."""
    up, down = X.powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CASED[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return X.mix((sums[ends] - sums[starts]) * down[starts]) | np.uint64(1)  # 0 marks a free slot


def pieces_agree(tokenizer_json: str, texts: list[str]) -> bool:
    """Whether piece-wise encoding gives what the tokenizer gives for these whole texts (a check for tests)."""
    encoder = PieceEncoder(tokenizer_json)
    if encoder.whole:
        return False
    return all(list(x) == y for x, y in zip(encoder.encode(pa.array(texts, pa.string())), encoder._ids(texts)))


_PLAIN_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
_WHITE_SPLITTERS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}


def _steps(part: dict | None, inner: str) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer, sequences opened up."""
    if part is None:
        return []
    return [x for step in part[inner] for x in _steps(step, inner)] if part["type"] == "Sequence" else [part]


def _matches_no_space(pattern: str) -> bool:
    """Whether a regular expression is of a kind whose matches hold no white space and see nothing around them."""
    rest = re.sub(r"\[\^\\s[^\]]*\]", "", pattern)  # [^\s...]: anything but white space
    return not re.search(r"\s|\.|\\[sSWDPbBAzZGXRKkg0-9xu]|\[\^|\(\?|[\^$]", rest)


def splits_at_white_space(tokenizer_json: str) -> bool:
    """Whether a text's ids are those of its white-space-separated pieces, told by the tokenizer's own parts.

    True for kinds known to be so: normalizers that change characters one by one
    or by composition (nothing composes with white space) or turn white space
    to a blank; a pre-tokenizer that splits at white space first, or keeps only
    matches without white space; added tokens without white space that take
    none in. False for anything else.
    """
    about = json.loads(tokenizer_json)
    for step in _steps(about.get("normalizer"), "normalizers"):
        blank = step["type"] == "Replace" and step.get("pattern") == {"Regex": "\\s+"} and step.get("content") == " "
        if step["type"] not in _PLAIN_NORMALIZERS and not blank:
            return False
    first = next(iter(_steps(about.get("pre_tokenizer"), "pretokenizers")), {"type": None})
    kept = first["type"] == "Split" and first.get("behavior") == "Removed" and first.get("invert") and _matches_no_space(first.get("pattern", {}).get("Regex", "."))
    if first["type"] not in _WHITE_SPLITTERS and not kept:
        return False
    added = about.get("added_tokens") or []
    return not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added)


def vocabulary_size(tokenizer_json: str) -> int:
    """One more than the largest id."""
    about = json.loads(tokenizer_json)
    vocab = about["model"]["vocab"]
    ids = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    return max([*ids, *(t["id"] for t in about.get("added_tokens") or [])], default=-1) + 1


def _sample(docs: DataFrame, sample_docs: int, longest: int) -> DataFrame:
    n = docs.count()
    drawn = docs.filter(ident_hash(F.col("doc_id"), 7) < int(min(1.0, sample_docs / max(n, 1)) * (1 << 30)))
    return drawn.filter(F.octet_length("text") <= longest)


def _trainer(tokenizer_json: str, whole: bool, end_id: int, width: str, size: int):
    def train(batches):
        key = (hashlib.sha256(tokenizer_json.encode()).hexdigest(), whole)
        encoder = worker_cache("piece encoder", key, lambda: PieceEncoder(tokenizer_json, whole))
        samples = [np.append(x, np.uint32(end_id)).astype(width).tobytes() for batch in batches for x in encoder.encode(batch.column(1))]
        yield pa.RecordBatch.from_arrays([pa.array([train_dictionary(samples, size)], pa.binary())], names=["dictionary"])
        X.release_memory()

    return train


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; empty if the samples are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, [s for s in samples if len(s) >= 8]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _writer(shared, end_id: int, block_docs: int):
    def write(batches):
        import zstandard

        tokenizer_json, whole, dictionary, width, level = shared.value
        key = (hashlib.sha256(tokenizer_json.encode()).hexdigest(), whole)
        encoder = worker_cache("piece encoder", key, lambda: PieceEncoder(tokenizer_json, whole))
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True)
        digest = hashlib.sha256(dictionary).hexdigest()
        part, block = TaskContext.get().partitionId(), 0
        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
        ids, counts, frames = [], [], []

        def flush():
            nonlocal ids, counts, frames, block
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
            row = [part, block, digest, np.array(ids, "<i8").tobytes(), np.array(counts, "<i8").tobytes(), offsets.tobytes(), b"".join(frames)]
            ids, counts, frames, block = [], [], [], block + 1
            kinds = [pa.int32(), pa.int64(), pa.string()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for doc_id, text_ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                whole_ids = np.append(text_ids, np.uint32(end_id)).astype(width)
                ids.append(doc_id)
                counts.append(len(whole_ids))
                frames.append(compressor.compress(whole_ids.tobytes()))
                if len(ids) == block_docs:
                    yield flush()
        if ids:
            yield flush()
        X.release_memory()

    return write


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 1,
    block_docs: int = 1024,
    dictionary_bytes: int = 65536,
    sample_docs: int = 800,
    sample_longest: int = 20000,
    level: int = 3,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the store below ``path``.

    The tokenizer file is read on the driver and sent to the tasks. The sample
    for the dictionary holds about ``sample_docs`` documents of at most
    ``sample_longest`` bytes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("doc_id is not null")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    width = "<u2" if max(vocabulary_size(tokenizer_json), end_id + 1) <= 1 << 16 else "<u4"
    whole = not splits_at_white_space(tokenizer_json)
    drawn = _sample(docs, sample_docs, sample_longest).repartition(1).sortWithinPartitions("doc_id", "text")
    trained = drawn.mapInArrow(_trainer(tokenizer_json, whole, end_id, width, dictionary_bytes), "dictionary binary").collect()
    dictionary = bytes(trained[0]["dictionary"]) if trained else b""
    about = [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary), width)]
    spark.createDataFrame(about, "dictionary_sha256 string, dictionary binary, width string").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((tokenizer_json, whole, dictionary, width, level))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(shared, end_id, block_docs), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def _reader(shared):
    def read(batches):
        import zstandard

        dictionary, width = shared.value
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=known)
        digest = hashlib.sha256(dictionary).hexdigest()
        for batch in batches:
            for part, block, needed, ids, counts, offsets, frames in zip(*(c for c in batch.columns)):
                if needed.as_py() != digest:
                    raise ValueError("the block needs another dictionary")
                doc_ids = np.frombuffer(ids.as_buffer(), "<i8")
                at = np.frombuffer(offsets.as_buffer(), "<i8")
                stated = np.frombuffer(counts.as_buffer(), "<i8")
                data = memoryview(frames.as_buffer())
                crc = np.empty(len(doc_ids), np.int64)
                for k in range(len(doc_ids)):
                    tokens = np.frombuffer(unpack.decompress(data[at[k] : at[k + 1]]), width)
                    if len(tokens) != stated[k]:
                        raise ValueError("a frame has another length than its index says")
                    crc[k] = zlib.crc32(tokens.astype("<u4").tobytes())
                before = np.cumsum(stated) - stated
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part.as_py(), np.int32)), pa.array(np.full(n, block.as_py())), pa.array(doc_ids), pa.array(before), pa.array(stated), pa.array(crc)],
                    names=["part", "block", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    return read


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").collect()[0]
    if hashlib.sha256(row["dictionary"]).hexdigest() != row["dictionary_sha256"]:
        raise ValueError("the dictionary does not match its hash")
    return bytes(row["dictionary"]), row["width"]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files.

    Starts come from the block counts, joined back to the decoded documents: a
    running sum over the blocks of a part, and one over the parts, which are as
    many as there were writing tasks.
    """
    shared = spark.sparkContext.broadcast(_dictionary(spark, path))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(_reader(shared), "part int, block long, doc_id long, before long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("part", "block", "counts").mapInArrow(_block_sizes, "part int, block long, total long")
    before = lambda order: F.coalesce(F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("total").alias("total")).select("part", before(Window.orderBy("part")).alias("part_start"))
    inside = sizes.select("part", "block", before(Window.partitionBy("part").orderBy("block")).alias("inside"))
    starts = inside.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("inside")).alias("block_start"))
    return docs.join(starts, ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _block_sizes(batches):
    for batch in batches:
        total = [int(np.frombuffer(c.as_buffer(), "<i8").sum()) for c in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64())], names=["part", "block", "total"])


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the document(s) with this id: only their frames are decompressed."""
    import zstandard

    dictionary, width = _dictionary(spark, path)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def frames(batches):
        for batch in batches:
            out = []
            for ids, offsets, data in zip(*batch.columns):
                at = np.frombuffer(offsets.as_buffer(), "<i8")
                for k in np.flatnonzero(np.frombuffer(ids.as_buffer(), "<i8") == doc_id):
                    out.append(bytes(memoryview(data.as_buffer())[at[k] : at[k + 1]]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    found = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").select("doc_ids", "offsets", "frames").mapInArrow(frames, "frame binary")
    return [np.frombuffer(unpack.decompress(bytes(r["frame"])), width) for r in found.collect()]
