"""Token ids in binary blocks, compressed document by document with one shared dictionary.

Layout of a block (little-endian):

====================  ==========================================================
4 bytes               ``TKB1``
uint32                documents in the block
uint32                bytes per id, 2 or 4
32 bytes              sha256 of the dictionary (zeros: none)
documents x 32 bytes  index: int64 doc_id, uint64 known (0: null id), uint64 end
                      of the document's frame, uint64 its ids
the rest              a zstandard frame per document, over its serialized ids
====================  ==========================================================

Blocks lie in ascending doc_id order in a Parquet table (``blocks``), a row each with its id range,
written by Spark so that a lost executor's attempt leaves nothing behind. The dictionary is its own
table beside it. One document is read through the id range, the index and one frame.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import parts
from ratingloom.llm.tokens import encoder

MAGIC = b"TKB1"
NO_DICTIONARY = bytes(32)
#: Bounds of the dictionary and of the sample it is trained on.
DICTIONARY_BYTES = 32_768
SAMPLE_DOCUMENTS = 1_000
SAMPLE_BYTES = 8_192
BLOCK_BYTES = 1 << 20
_HEAD = "<4sII32s"
_HEAD_BYTES = struct.calcsize(_HEAD)
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "<u8"), ("frame_end", "<u8"), ("ids", "<u8")])
_BLOCK = "part int, part_start bigint, first_id bigint, last_id bigint, n_docs bigint, n_tokens bigint, block binary"


def serialize(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def deserialize(raw: bytes, width: int) -> bytes:
    return np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()


def _sample(docs: DataFrame, path: str, end_id: int, width: int) -> list[bytes]:
    ids = docs.select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(SAMPLE_DOCUMENTS)
    picked = docs.join(F.broadcast(ids.select("id").distinct()), "id").limit(2 * SAMPLE_DOCUMENTS)
    tail = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield [[serialize(x + tail, width)[:SAMPLE_BYTES] for x in encoder(path).encode(texts)]]

    return sorted(bytes(r["raw"]) for r in map_batches(picked.select("text"), run, "raw binary").collect())


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too little sample text for training serves as the dictionary itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _codec(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else NO_DICTIONARY


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text, null as empty, appends ``end_id`` and writes blocks in id order.

    Ids are integers. Rows that repeat an id stay, one after the other in text order; null ids
    come first. An empty table gives an empty folder of blocks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    width = 2 if max(end_id, encoder(tokenizer).vocabulary - 1) < 1 << 16 else 4
    dictionary = train_dictionary(_sample(docs, tokenizer, end_id, width))
    spark.createDataFrame([(dictionary, _digest(dictionary).hex())], "dictionary binary, sha256 string").coalesce(1).write.parquet(f"{folder}/dictionary")
    tail = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        shared, known = _codec(dictionary), _digest(dictionary)
        pack = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True)
        part, before = TaskContext.get().partitionId(), 0
        index: list[tuple] = []
        body: list[bytes] = []
        size = 0

        def block() -> list:
            nonlocal before, index, body, size
            table = np.array(index, _INDEX)
            raw = struct.pack(_HEAD, MAGIC, len(index), width, known) + table.tobytes() + b"".join(body)
            ids, total = table["doc_id"][table["known"] == 1].tolist(), int(table["ids"].sum())
            row = (part, before, min(ids, default=None), max(ids, default=None), len(index), total, raw)
            before, index, body, size = before + total, [], [], 0
            return [[x] for x in row]

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist())):
                ids += tail
                body.append(pack.compress(serialize(ids, width)))
                size += len(body[-1])
                index.append((doc_id or 0, doc_id is not None, size, len(ids) // 4))
                if size >= BLOCK_BYTES:
                    yield block()
        if index:
            yield block()

    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(parts(spark), "id", "h").sortWithinPartitions("id", "h", "text")
    map_batches(ordered.drop("h"), run, _BLOCK).write.option("compression", "none").parquet(f"{folder}/blocks")


def _frames(block: bytes, dictionary: bytes) -> Iterator[tuple[int | None, int, bytes]]:
    """Id, start in the block and ids of each document of a block."""
    magic, count, width, known = struct.unpack_from(_HEAD, block)
    if magic != MAGIC or known != _digest(dictionary):
        raise ValueError("not a block of this dictionary")
    index = np.frombuffer(block, _INDEX, count, _HEAD_BYTES)
    unpack = zstandard.ZstdDecompressor(dict_data=_codec(dictionary))
    base, begin, start = _HEAD_BYTES + index.nbytes, 0, 0
    for row in index:
        end = int(row["frame_end"])
        ids = deserialize(unpack.decompress(block[base + begin:base + end]), width)
        yield (int(row["doc_id"]) if row["known"] else None), start, ids
        begin, start = end, start + int(row["ids"])


def _dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])


def _starts(blocks: DataFrame) -> DataFrame:
    """Ids before each part: one row per partition that was written."""
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the blocks: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and, if asked for, its ids as little-endian unsigned 32-bit integers."""
    dictionary = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    schema = "part int, start bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for part, before, block in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [
                    (part, before + start, doc_id, len(ids) // 4, zlib.crc32(ids)) + (ids,) * with_ids
                    for doc_id, start, ids in _frames(block, dictionary)
                ]
                yield list(zip(*rows))

    found = map_batches(blocks.select("part", "part_start", "block"), run, schema)
    # as many rows as partitions were written, so small enough to send to every task
    done = found.join(F.broadcast(_starts(blocks)), "part")
    return done.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """The ids of one document, from one block and one frame; None if there is no such id."""
    rows = spark.read.parquet(f"{folder}/blocks").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("block")
    dictionary = _dictionary(spark, folder)
    for row in rows.toLocalIterator():
        block = bytes(row["block"])
        _, count, width, _ = struct.unpack_from(_HEAD, block)
        index = np.frombuffer(block, _INDEX, count, _HEAD_BYTES)
        at = np.flatnonzero((index["doc_id"] == doc_id) & (index["known"] == 1))
        if len(at):
            base = _HEAD_BYTES + index.nbytes
            begin = int(index["frame_end"][at[0] - 1]) if at[0] else 0
            unpack = zstandard.ZstdDecompressor(dict_data=_codec(dictionary))
            raw = unpack.decompress(block[base + begin:base + int(index["frame_end"][at[0]])])
            return np.frombuffer(raw, f"<u{width}").tolist()
    return None
