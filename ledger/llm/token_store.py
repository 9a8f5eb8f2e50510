"""Token ids as a binary store: one zstandard frame per document over a shared dictionary.

A store is a folder of two Parquet tables, so any file system that Spark writes is fine and lost executors cost a task only.

``dictionary``: one row with the dictionary, its hash, the id width in bytes and the tokenizer's name.
``blocks``: documents in ascending id order, packed into blocks of about ``BLOCK_BYTES``.  A block carries the dictionary's hash, its place
(``shard``, ``block``), the offset index (``doc_ids``, ``offsets``, ``counts``) and ``payload``, the frames one after the other.  The index columns are read without
the payloads, and a document is read by slicing its frame out of one payload.

The dictionary is trained on the serialized ids of at most ``SAMPLE_DOCS`` documents (those with the smallest hashes), of longer ones on
``SAMPLE_CHARS`` characters from a place that the hash picks: short documents are what it is for.  It changes sizes only, never contents.  Ids below 65,536 take two bytes.

Defined results: null texts are empty and have the end id only; documents with equal ids follow each other in the order of
their hashes; null ids come first; an empty table gives an empty store, read back as an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledger.llm.common import named
from ledger.llm.token_counts import byte_characters
from ledger.session import scratch

END_ID = 0
BLOCK_BYTES = 1 << 20
LEVEL = 3
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 4000
#: Pieces whose ids a worker remembers; beyond them it starts anew.
MEMORY_PIECES = 600_000
_PIECE = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")


class Encoder:
    """Ids of texts by a byte-level BPE file, with the ids of pieces remembered.

    The merges never cross the pieces that the tokenizer's own pattern cuts, so the ids of a text are those of its pieces; the library's merge
    model gives them from the characters that stand for their bytes.  A text goes to the library whole if it holds a special token or a character that the pattern here and the library's class differently.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.width = 2 if max(self.library.get_vocab_size(with_added_tokens=True) - 1, END_ID) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pieces: dict[str, bytes] = {}
        self.classed: dict[str, bool] = {}
        self.end = np.array([END_ID], self.kind).tobytes()
        self.code = {2: "H", 4: "I"}[self.width]
        self.shown = byte_characters()
        #: ASCII characters around which the patterns cut differently: some separators count as white space here only.
        self.differs = [c for c in map(chr, range(128)) if not self._agrees(c)]

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _agrees(self, char: str) -> bool:
        """Whether both patterns cut around ``char`` alike."""
        if char not in self.classed:
            probe = f"a{char}a1{char}1!{char}! {char} {char}{char}  {char}\n{char}"
            theirs = [probe[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            self.classed[char] = theirs == _PIECE.findall(probe)
        return self.classed[char]

    def __call__(self, text: str | None) -> bytes:
        """The serialized ids of ``text`` with the end id."""
        if not text:
            return self.end
        if any(s in text for s in self.special) or any(c in text for c in self.differs) or not (text.isascii() or all(self._agrees(c) for c in set(text) if c > "\x7f")):
            return self.whole(text) + self.end
        found = _PIECE.findall(text)
        try:
            return b"".join(map(self.pieces.__getitem__, found)) + self.end
        except KeyError:
            return b"".join([self.piece(p) for p in found]) + self.end

    def piece(self, piece: str) -> bytes:
        """Serialized ids of one piece, remembered."""
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) >= MEMORY_PIECES:
                self.pieces.clear()
            shown = piece.encode().decode("latin-1").translate(self.shown)
            known = self.pieces[piece] = array(self.code, [t.id for t in self.library.model.tokenize(shown)]).tobytes()
        return known


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _sampled_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """Train on the sample in one task; empty if there is too little to train on."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        samples = [encode(t) for b in batches for t in b.column(0).to_pylist()]
        total = sum(map(len, samples))
        blob = b""
        if len(samples) >= 20 and total >= 1 << 14:
            try:
                blob = zstandard.train_dictionary(min(DICT_BYTES, total // 8), samples).as_bytes()
            except zstandard.ZstdError:  # too uniform to train on
                blob = b""
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["dictionary"])

    # A hash threshold lets through about four times the sample, so what meets in one task does not grow with the table.
    text, share = named("text"), min(1.0, 4 * SAMPLE_DOCS / max(docs.count(), 1))
    sample = (
        docs.select(text.alias("_text"), F.pmod(F.xxhash64(named("doc_id"), text), F.lit(1 << 40)).alias("_h"))
        .filter((F.col("_h") <= int(share * (1 << 40))) & F.col("_text").isNotNull())
        .withColumn("_text", F.substr("_text", (F.col("_h") % (F.greatest(F.length("_text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS)))
        .orderBy("_h").limit(SAMPLE_DOCS).select("_text")
    )
    found = sample.coalesce(1).mapInArrow(train, "dictionary binary").first()
    return bytes(found["dictionary"]) if found else b""


def _hash(dictionary: bytes) -> int:
    return zlib.crc32(dictionary)


def _zstd_dict(blob: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(blob) if blob else None


def write_store(docs: DataFrame, path: str, tokenizer: str, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode the texts of ``docs`` and write them to ``path``."""
    spark = docs.sparkSession
    blob = _sampled_dictionary(docs, tokenizer)
    digest = _hash(blob)
    kind = dict(docs.dtypes)["doc_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        pressed = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd_dict(blob), write_content_size=True, write_checksum=False)
        ids, offsets, counts, frames, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([digest], pa.int64()), pa.array([sum(counts)], pa.int64()),
                 pa.array([ids], pa.list_(id_type)), pa.array([offsets], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([b"".join(frames)], pa.binary())],
                ["shard", "block", "dict_hash", "n_tokens", "doc_ids", "offsets", "counts", "payload"])

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = encode(text.as_py())
                frame = pressed.compress(raw)
                ids.append(doc_id)
                offsets.append(size)
                counts.append(len(raw) // encode.width)
                frames.append(frame)
                size += len(frame)
                if size >= block_bytes:
                    yield flush()
                    block += 1
                    ids, offsets, counts, frames, size = [], [], [], [], 0
        if ids:
            yield flush()

    rows = docs.select(named("doc_id").alias("_id"), F.coalesce(named("text"), F.lit("")).alias("_text"))
    (
        rows.withColumn("_h", F.xxhash64("_text"))
        .repartitionByRange("_id", "_h").sortWithinPartitions("_id", "_h")
        .select("_id", "_text")
        .mapInArrow(pack, f"shard int, block int, dict_hash bigint, n_tokens bigint, doc_ids array<{kind}>, "
                          "offsets array<bigint>, counts array<bigint>, payload binary")
        .write.parquet(f"{path}/blocks")
    )
    width = encoder(tokenizer).width
    spark.createDataFrame([(bytearray(blob), digest, width, os.path.basename(tokenizer))],
                          "dictionary binary, dict_hash bigint, width int, tokenizer string").coalesce(1).write.parquet(f"{path}/dictionary")


def _opened(spark: SparkSession, path: str) -> tuple[bytes, int, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    blob = bytes(row["dictionary"])
    if _hash(blob) != row["dict_hash"]:
        raise ValueError(f"damaged dictionary in {path}")
    return blob, row["dict_hash"], row["width"]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the store: doc_id, start, n_tokens, ids_crc32 (of all ids as little-endian 32-bit integers), n_bytes (of its frame)."""
    blob, digest, width = _opened(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = dict(blocks.dtypes)["doc_ids"][6:-1]
    # Starts of blocks: running sums inside a shard, and over the shards' totals (one row per written partition).
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("_sum"))
    shards = shards.select(F.col("shard").alias("_shard"), F.coalesce(
        F.sum("_sum").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.select("shard", "block", "n_tokens").withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(shards, F.col("shard") == F.col("_shard"))
        .select("shard", "block", (F.col("_inside") + F.col("_shard_start")).alias("start"))
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor(dict_data=_zstd_dict(blob))
        stored = np.dtype(f"<u{width}")
        for batch in batches:
            for i in range(batch.num_rows):
                shard, block, found, ids, offsets, counts, payload = (batch.column(c)[i] for c in range(7))
                if found.as_py() != digest:
                    raise ValueError("block written with another dictionary")
                payload, counts = payload.as_buffer(), counts.values.to_numpy()
                ends = np.append(offsets.values.to_numpy()[1:], payload.size)
                crcs = []
                for a, b, n in zip(offsets.values.to_numpy().tolist(), ends.tolist(), counts.tolist(), strict=True):
                    tokens = np.frombuffer(opened.decompress(payload[a:b]), stored)
                    if len(tokens) != n:
                        raise ValueError("offset index and frame differ")
                    crcs.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                before = np.cumsum(counts) - counts
                size = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, shard.as_py(), np.int32)), pa.array(np.full(size, block.as_py(), np.int32)), ids.values, pa.array(before),
                     pa.array(counts), pa.array(np.array(crcs, np.int64)), pa.array(ends - offsets.values.to_numpy())],
                    ["_shard", "_block", "doc_id", "_before", "n_tokens", "ids_crc32", "n_bytes"])

    docs = blocks.select("shard", "block", "dict_hash", "doc_ids", "offsets", "counts", "payload").mapInArrow(
        unpack, f"_shard int, _block int, doc_id {kind}, _before bigint, n_tokens bigint, ids_crc32 bigint, n_bytes bigint")
    return docs.join(starts, (F.col("_shard") == F.col("shard")) & (F.col("_block") == F.col("block"))).select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32", "n_bytes")


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids (end id included) of every document with this id: one frame is read out of one payload each."""
    blob, _, width = _opened(spark, path)
    at = F.array_position("doc_ids", doc_id)
    rows = spark.read.parquet(f"{path}/blocks").filter(F.array_contains("doc_ids", doc_id)).select("doc_ids", "offsets", at.alias("at"), "payload").collect()
    opened, out = zstandard.ZstdDecompressor(dict_data=_zstd_dict(blob)), []
    for row in rows:
        ends = [*row["offsets"][1:], len(row["payload"])]
        out += [np.frombuffer(opened.decompress(bytes(row["payload"][a:b])), f"<u{width}").tolist()
                for d, a, b in zip(row["doc_ids"], row["offsets"], ends, strict=True) if d == doc_id]
    return out


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write a store and read it back."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_store(docs, path, tokenizer)
    return read_store(spark, path)
