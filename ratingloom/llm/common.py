"""What the corpus operators share: folds, written intermediates, word and shingle hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.workspace import fresh_path, shared_dir

#: The six characters that separate words in the contracts.
WORD_SPACE = b" \t\n\v\f\r"


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids count as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def saved(table: DataFrame, label: str) -> DataFrame:
    """The table, written once to the shared folder and read back, so that no loss of an executor
    makes Spark compute it again."""
    spark = table.sparkSession
    path = fresh_path(spark, label)
    table.write.parquet(path)
    back = spark.read.schema(table.schema).parquet(path)
    back.written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Removes what ``saved`` wrote, for tables that nothing reads any more."""
    for table in tables:
        if path := getattr(table, "written_to", None):
            sc = table.sparkSession.sparkContext
            folder = sc._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def parts(spark: SparkSession) -> int:
    """Shuffle partitions as the session has them: the submitter sizes them to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[list(WORD_SPACE)] = True


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends."""
    inside = ~_SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's words start.

    The result has one more offset than texts. Words are runs of bytes outside WORD_SPACE; a hash
    depends on the word's bytes only.
    """
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    start, end = word_bounds(joined)
    sizes = np.array([len(t) for t in texts], np.int64) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    offsets = np.searchsorted(start, bounds)
    hashes = np.empty(len(start), np.uint64)
    step = 1 << 20
    inverse = pow(int(_BASE), -1, 1 << 64)
    lo = 0
    while lo < len(start):  # in pieces, so that the arrays of powers stay small
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + step, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * _powers(b - a, int(_BASE)), out=total[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        back = _powers(int(s[-1]) + 1, inverse)
        hashes[lo:hi] = mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))
        lo = hi
    return hashes, offsets


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` consecutive values; the array is shorter by width - 1."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[k:k + n]
    return mix(out)


def batches(texts: list[bytes], most: int):
    """Index ranges of consecutive texts of at most ``most`` bytes together, one text at least."""
    lo = size = 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > most:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


__all__ = ["WORD_SPACE", "batches", "combine", "discard", "fold", "fresh_path", "mix", "parts", "saved", "shared_dir", "word_bounds", "word_hashes"]
