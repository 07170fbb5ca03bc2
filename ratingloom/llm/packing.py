"""Bounded-space online packing of token ids into sequences of a fixed size.

Every partition keeps a fixed number of open windows. A document's whole windows leave at once; its
rest goes to the open window it fits best. Where it fits none and all windows are open, the fullest
leaves, filled up with a part of the rest if at least ``min_piece`` ids fit. What is left open at
the end of the partitions is merged by groups of partitions, round by round, until one group has
packed all of it; there the windows are filled up from each other, so that one is short at most.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches, map_groups
from ratingloom.llm.common import saved
from ratingloom.llm.tokens import encoder

SIZE = 2048
OPEN_WINDOWS = 64
MIN_PIECE = 16
#: Partitions (later groups) whose open windows one task of a merging round packs.
FAN_IN = 16
_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, part int"


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) in the order they come; ids are 4 bytes each."""

    def __init__(self, size: int = SIZE, open_windows: int = OPEN_WINDOWS, min_piece: int = MIN_PIECE):
        self.size, self.most, self.min_piece = size, open_windows, min_piece
        self.free: list[int] = []
        self.pieces: list[list[tuple]] = []
        self.full: list[list[tuple]] = []

    def _close(self, at: int) -> None:
        self.full.append(self.pieces.pop(at))
        self.free.pop(at)

    def _put(self, at: int, piece: tuple) -> None:
        self.pieces[at].append(piece)
        self.free[at] -= len(piece[2]) // 4
        if not self.free[at]:
            self._close(at)

    def _open(self, piece: tuple) -> None:
        self.free.append(self.size)
        self.pieces.append([])
        self._put(len(self.free) - 1, piece)

    def add(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        whole = 4 * self.size
        at = 0
        while len(ids) - at >= whole:
            self.full.append([(doc_id, start + at // 4, ids[at:at + whole], doc_tokens)])
            at += whole
        while at < len(ids):
            n = (len(ids) - at) // 4
            fits = [f for f in self.free if f >= n]
            if fits:
                self._put(self.free.index(min(fits)), (doc_id, start + at // 4, ids[at:], doc_tokens))
                return
            if len(self.free) < self.most:
                self._open((doc_id, start + at // 4, ids[at:], doc_tokens))
                return
            fullest = self.free.index(gap := min(self.free))
            if gap >= self.min_piece:
                self._put(fullest, (doc_id, start + at // 4, ids[at:at + 4 * gap], doc_tokens))
                at += 4 * gap
            else:
                self._close(fullest)

    def take(self) -> list[list[tuple]]:
        out, self.full = self.full, []
        return out

    def merge(self) -> None:
        """Fill windows up from the emptiest ones, so that at most one stays short."""
        spare = sorted(zip(self.free, self.pieces), key=lambda x: x[0])
        self.free, self.pieces = [], []
        one = Packer(self.size, 1, 1)
        for _, pieces in spare:
            for piece in pieces:
                one.add(*piece)
        self.full += one.full
        self.free, self.pieces = one.free, one.pieces


def _rows(windows: list[list[tuple]], ids_of: int, part: int, with_ids: bool) -> list[tuple]:
    """Rows of windows numbered on from ``ids_of``; open windows carry their ids on."""
    out = []
    for k, pieces in enumerate(windows):
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            out.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, ids_of + k, offset, ids if with_ids else None, part))
            offset += n
    return out


def _number(level: int, group: int, k: int = 0) -> int:
    """Sequence ids that no other task gives out: round, task and number within."""
    return (level << 56) | (group << 32) | k


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    size: int = SIZE, open_windows: int = OPEN_WINDOWS, min_piece: int = MIN_PIECE, with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents with their place in the sequences.

    Null and empty texts are the end id alone; rows that repeat an id are packed each on its own.
    ``ids`` holds a piece's ids (little-endian unsigned 32-bit) if asked for. An empty table gives
    no pieces.
    """
    tail = struct.pack("<I", end_id)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        part, given = TaskContext.get().partitionId(), 0
        packer = Packer(size, open_windows, min_piece)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist())):
                ids += tail
                packer.add(doc_id, 0, ids, len(ids) // 4)
                done = packer.take()
                rows += _rows(done, _number(0, part, given), -1, with_ids)
                given += len(done)
                if len(rows) >= 2000:
                    yield list(zip(*rows))
                    rows = []
            if rows:
                yield list(zip(*rows))
        encoder(tokenizer).words.clear()  # a worker that is used again starts small
        if packer.pieces:
            yield list(zip(*_rows(packer.pieces, _number(0, part, given), part, True)))

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    packed = saved(map_batches(given, first, _PIECE), "packed")
    most = packed.agg(F.max("part")).first()[0]
    groups = 0 if most is None else most + 1
    out = packed.where("part < 0")
    left = packed.where("part >= 0")
    level = 0
    while groups:
        level += 1
        groups = -(-groups // FAN_IN)
        merged = saved(_merge(left, level, groups == 1, size, open_windows, min_piece, with_ids), f"merged-{level}")
        out = out.unionByName(merged.where("part < 0"))
        left = merged.where("part >= 0")
        if groups == 1:
            break
    return out.drop("part") if with_ids else out.drop("part", "ids")


def _merge(left: DataFrame, level: int, last: bool, size: int, open_windows: int, min_piece: int, with_ids: bool) -> DataFrame:
    """Packs the open windows of FAN_IN tasks in one; their number bounds what a task holds."""

    def run(rows: pa.Table) -> list:
        group = rows.column("group")[0].as_py()
        packer = Packer(size, open_windows, min_piece)
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for piece in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
            packer.add(*piece)
        packer.merge()
        done = packer.take()
        out = _rows(done, _number(level, group), -1, with_ids)
        out += _rows(packer.pieces, _number(level, group, len(done)), -1 if last else group, with_ids or not last)
        return list(zip(*out))

    grouped = left.withColumn("group", F.floor(F.col("part") / FAN_IN).cast("int"))
    return map_groups(grouped, ["group"], run, left.schema)
