"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a seed (a run of ``SEED`` tokens) are tiled: the longest common
runs of tokens that are still unmarked on both sides are found by running Karp-Rabin hashes, marked,
and the search goes on with shorter runs, down to the seed. The share of an item's tokens under
tiles is its coverage, whatever the order the tiles stand in. Tokens are words in lower case without
ASCII punctuation.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import batches, combine, mix, word_hashes

SEED = 5
COVERAGE = 0.5
#: Bytes of test items up to which they go to every task; above it seeds are joined by a shuffle.
SENT_BYTES = 8 << 20
_BATCH_BYTES = 4 << 20
_PLAIN = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15


def token_lists(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashed tokens of each text."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN) for t in texts]
    for lo, hi in batches(raw, _BATCH_BYTES):
        hashes, at = word_hashes(raw[lo:hi])
        for a, b in zip(at[:-1], at[1:]):
            yield hashes[a:b]


def seeds(tokens: np.ndarray, widths: tuple[int, ...]) -> np.ndarray:
    """Hashes of all runs of the given widths."""
    return np.concatenate([combine(tokens, w) + np.uint64(w) for w in widths]) if widths else np.zeros(0, np.uint64)


def width_of(tokens: np.ndarray, seed: int) -> int:
    return min(seed, len(tokens))


class _Rolling:
    """Hashes of runs of any length, from sums of weighted tokens."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        self.tokens, self.free = tokens, np.ones(n, bool)
        power = np.full(n + 1, np.uint64(_BASE), np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.back = np.full(n + 1, np.uint64(pow(_BASE, -1, 1 << 64)), np.uint64)
        self.back[0] = 1
        self.back = np.multiply.accumulate(self.back)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * power[:n], out=self.total[1:])

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the unmarked runs of ``size`` tokens."""
        n = len(self.tokens) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        marked = np.concatenate([[0], np.cumsum(~self.free)])
        at = np.flatnonzero(marked[size:] == marked[:-size])
        return at, mix((self.total[at + size] - self.total[at]) * self.back[at])


def tile(item: np.ndarray, document: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles (start in the item, start in the document, tokens), longest first."""
    one, two = _Rolling(item), _Rolling(document)
    tiles = []
    size = len(item)
    while size >= least and least:
        mine, names = one.runs(size)
        theirs, other = two.runs(size)
        hit = np.isin(other, names)
        places = defaultdict(list)
        for at, name in zip(theirs[hit].tolist(), other[hit].tolist()):
            places[name].append(at)
        found = []
        for i, name in zip(mine.tolist(), names.tolist()):
            for j in places.get(name, ()):
                n = size  # hashes are of 64 bits; the tokens decide
                if not np.array_equal(item[i:i + n], document[j:j + n]):
                    continue
                while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and one.free[i + n] and two.free[j + n]:
                    n += 1
                found.append((-n, i, j))
        heapq.heapify(found)
        while found:
            n, i, j = heapq.heappop(found)
            free = one.free[i:i - n] & two.free[j:j - n]
            if free.all():
                one.free[i:i - n] = two.free[j:j - n] = False
                tiles.append((i, j, -n))
            else:  # what is still free of it waits its turn by length; shorter runs wait for their size
                edge = np.flatnonzero(np.diff(np.concatenate([[0], free, [0]])))
                for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
                    if b - a >= size:
                        heapq.heappush(found, (a - b, i + a, j + a))
        size = size - 1 if size <= least else max(least, size // 2)
    return tiles


def _leaks(tokens: np.ndarray, items: list[tuple], seed: int, coverage: float) -> Iterator[tuple]:
    for item_id, item in items:
        if len(item):
            tiles = tile(item, tokens, width_of(item, seed))
            share = sum(t[2] for t in tiles) / len(item)
            if share >= coverage:
                yield item_id, share, len(tiles), max(t[2] for t in tiles), sorted((j, j + n) for _, j, n in tiles)


_FOUND = "item_id bigint, coverage double, n_tiles bigint, longest_tile bigint, spans array<struct<low:bigint,high:bigint>>"


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    seed: int = SEED, coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs of a document and a test item it covers by at least ``coverage``, with the tiles'
    token spans in the document.

    Null and empty texts are covered by nothing and cover nothing. An item shorter than a seed is
    one seed. Rows that repeat an id give a row each; items that repeat an id likewise. Item ids are
    whole numbers or text of them.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("item")).where("item <> ''")
    size = items.agg(F.sum(F.octet_length("item") + 16)).first()[0] or 0
    found = _sent(docs, items, seed, coverage) if size <= SENT_BYTES else _shuffled(docs, items, seed, coverage)
    return found.withColumnRenamed("id", id_col)


def _sent(docs: DataFrame, items: DataFrame, seed: int, coverage: float) -> DataFrame:
    """Test items of a checked size go to every task, and each text is read once."""
    rows = sorted(((r["item_id"], r["item"]) for r in items.collect()), key=lambda r: (r[0] is None, r))
    lists = [(r[0], t) for r, t in zip(rows, token_lists([r[1] for r in rows]))]
    widths = tuple(sorted({width_of(t, seed) for _, t in lists} - {0}))
    own = [np.unique(seeds(t, (width_of(t, seed),))) if len(t) else np.zeros(0, np.uint64) for _, t in lists]
    names = np.concatenate(own) if own else np.zeros(0, np.uint64)
    order = np.argsort(names, kind="stable")
    names, holders = names[order], np.repeat(np.arange(len(own)), [len(x) for x in own])[order]
    sent = docs.sparkSession.sparkContext.broadcast((lists, names, holders))
    kind = docs.schema["id"].dataType.simpleString()

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        lists, names, holders = sent.value
        for batch in given:
            rows = []
            for doc_id, tokens in zip(batch.column(0).to_pylist(), token_lists(batch.column(1).to_pylist())):
                mine = np.unique(seeds(tokens, widths))
                low, high = np.searchsorted(names, mine), np.searchsorted(names, mine, "right")
                hit = np.flatnonzero(low < high)
                if len(hit):
                    some = sorted({int(h) for k in hit for h in holders[low[k]:high[k]]})
                    rows += [(doc_id, *x) for x in _leaks(tokens, [lists[k] for k in some], seed, coverage)]
            if rows:
                yield [list(c) for c in zip(*rows)]

    return map_batches(docs, run, f"id {kind}, {_FOUND}")


def _shuffled(docs: DataFrame, items: DataFrame, seed: int, coverage: float) -> DataFrame:
    """Seeds of documents meet seeds of items in a join, and only the pairs found are tiled."""
    kind = docs.schema["id"].dataType.simpleString()
    docs = docs.withColumn("h", F.xxhash64("text"))

    def seeds_of(key: list[str], widths: tuple[int, ...] | None):
        def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
            for batch in given:
                found = []
                for tokens in token_lists(batch.column(len(key)).to_pylist()):
                    own = widths if widths is not None else ((width_of(tokens, seed),) if len(tokens) else ())
                    found.append(np.unique(seeds(tokens, own)).view(np.int64).tolist())
                yield [*batch.columns[:len(key)], found]
        return run

    theirs = map_batches(items.select("item_id", F.xxhash64("item").alias("g"), "item"), seeds_of(["item_id", "g"], None), "item_id bigint, g bigint, seeds array<bigint>")
    mine = map_batches(docs.select("id", "h", "text"), seeds_of(["id", "h"], tuple(range(1, seed + 1))), f"id {kind}, h bigint, seeds array<bigint>")
    pairs = mine.select("id", "h", F.explode("seeds").alias("seed")).join(theirs.select("item_id", "g", F.explode("seeds").alias("seed")), "seed")
    pairs = pairs.select("id", "h", "item_id", "g").distinct()
    keyed = items.withColumn("g", F.xxhash64("item"))
    same_item = pairs["item_id"].eqNullSafe(keyed["item_id"]) & (pairs["g"] == keyed["g"])
    with_item = pairs.join(keyed, same_item).select(pairs["id"], pairs["h"], pairs["item_id"], "item")
    same_doc = docs["id"].eqNullSafe(with_item["id"]) & (docs["h"] == with_item["h"])
    joined = docs.join(with_item, same_doc).select(docs["id"], "item_id", "text", "item")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            rows = []
            columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), token_lists(batch.column(2).to_pylist()), token_lists(batch.column(3).to_pylist())
            for doc_id, item_id, tokens, item in zip(*columns):
                rows += [(doc_id, *x) for x in _leaks(tokens, [(item_id, item)], seed, coverage)]
            if rows:
                yield [list(c) for c in zip(*rows)]

    return map_batches(joined, run, f"id {kind}, {_FOUND}")
