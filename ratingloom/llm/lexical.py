"""Ranked lexical search of many items at once, with the work that items share done once.

Items are dealt into blocks of bounded size. Terms that stand in the same items of a block are one
symbol from the start; then the pair of symbols that most items share becomes a new symbol in all of
them, again and again, until no two items share a pair. The result is a graph of sums: every symbol
is a term, or the sum of two or more symbols below it, and an item is the sum of the few symbols it
is left with. Documents are scored in batches: the terms' scores fill the lowest rows of a matrix of
partial accumulators, every shared symbol is added up once from the rows below it, and the items
combine these rows. A task keeps each item's best k documents and gives out those alone.

Sums are of 64-bit integers, so their order does not matter and results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches, map_groups
from ratingloom.llm.common import saved

BEST = 10
#: Term occurrences of items in a block; a block's graph and terms go to all tasks.
BLOCK_TERMS = 100_000
#: Symbols of an item whose pairs are counted together, in order of how many items hold them.
SPAN = 64
#: Bytes of accumulators of a batch of documents.
BATCH_BYTES = 48 << 20
#: Documents are cut into words in pieces of about this many bytes.
PIECE = 4 << 20

#: Every byte that is part of no term becomes a space, A to Z become lower case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, piece by piece."""
    lo = 0
    while lo < len(text):
        hi = lo + PIECE
        if hi < len(text):  # not inside a term
            plain = text[hi:hi + PIECE].translate(_TABLE)
            cut = plain.find(b" ")
            while cut < 0 and hi + len(plain) < len(text):
                hi += len(plain)
                plain = text[hi:hi + PIECE].translate(_TABLE)
                cut = plain.find(b" ")
            hi = hi + cut if cut >= 0 else len(text)
        yield text[lo:hi].translate(_TABLE).split()
        lo = hi


def _raw(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary()).to_pylist()


class Sharing:
    """The graph of sums for the term sets of some items."""

    def __init__(self, items: list[list[int]]):
        self.items = items
        holders: dict[int, list[int]] = defaultdict(list)
        for item, own in enumerate(items):
            for term in own:
                holders[term].append(item)
        same: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for term, found in sorted(holders.items()):
            same[tuple(found)].append(term)
        #: symbols made as sums of others, in an order that has the parts first
        self.sums: list[tuple[int, list[int]]] = []
        self.next = max(holders, default=-1) + 1
        left: list[set[int]] = [set() for _ in items]
        for found, group in same.items():
            symbol = group[0] if len(group) == 1 or len(found) == 1 else self._sum(group)
            for item in found:
                left[item].update(group if len(found) == 1 else [symbol])
        self._share_pairs(left)
        self.left = [sorted(x) for x in left]

    def _sum(self, parts: list[int]) -> int:
        self.sums.append((self.next, list(parts)))
        self.next += 1
        return self.next - 1

    def _share_pairs(self, left: list[set[int]]) -> None:
        """Replaces pairs of symbols by their sum, those of most items first."""
        while True:
            held = Counter(s for own in left for s in own)
            pairs: dict[tuple[int, int], list[int]] = defaultdict(list)
            for item, own in enumerate(left):
                shared = sorted((s for s in own if held[s] > 1), key=lambda s: (-held[s], s))
                for lo in range(0, len(shared), SPAN):
                    span = sorted(shared[lo:lo + SPAN])
                    for i, a in enumerate(span):
                        for b in span[i + 1:]:
                            pairs[a, b].append(item)
            heap = [(-len(found), pair) for pair, found in pairs.items() if len(found) > 1]
            heapq.heapify(heap)
            done = 0
            while heap:
                number, (a, b) = heapq.heappop(heap)
                found = [i for i in pairs[a, b] if a in left[i] and b in left[i]]
                if len(found) < 2:
                    continue
                if len(found) < -number:  # others took symbols away: to its new place in the order
                    pairs[a, b] = found
                    heapq.heappush(heap, (-len(found), (a, b)))
                    continue
                symbol = self._sum([a, b])
                done += 1
                for i in found:
                    left[i] -= {a, b}
                    left[i].add(symbol)
            if not done:
                return

    def additions(self) -> tuple[int, int]:
        """Additions of rows with sharing and without."""
        shared = sum(len(p) - 1 for _, p in self.sums) + sum(max(0, len(x) - 1) for x in self.left)
        return shared, sum(max(0, len(x) - 1) for x in self.items)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item and term, once for each; an item's term null if it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), _raw(batch.column(1))):
                own = set().union(*terms(text)) if text else set()
                ids += [item] * len(own)
                found += sorted(own)
            yield [pa.array(ids, pa.int64()), pa.array(found, pa.binary())]

    given = items.select(F.col(id_col).cast("bigint").alias("item"), F.col(text_col).cast("string").alias("text"))
    return map_batches(given, run, "item bigint, term binary").distinct()


def _graph(block: DataFrame) -> DataFrame:
    """A block's terms in order, its items, and its graph of sums."""

    def run(rows: pa.Table) -> list:
        words = sorted(set(rows.column("term").to_pylist()))
        number = {w: k for k, w in enumerate(words)}
        own: dict[int | None, list[int]] = defaultdict(list)
        for item, term in zip(rows.column("item").to_pylist(), rows.column("term").to_pylist()):
            own[item].append(number[term])
        ids = list(own)
        graph = Sharing([sorted(own[i]) for i in ids])
        return [[rows.column("block")[0].as_py()], [words], [ids], [graph.left], [[p for _, p in graph.sums]]]

    ddl = "block bigint, terms array<binary>, items array<bigint>, rests array<array<int>>, sums array<array<int>>"
    return saved(map_groups(block, ["block"], run, ddl), "search-graphs")


def _hits(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """Per document its number of terms, and which of ``words`` it holds how often."""
    number = {w: k for k, w in enumerate(words)}
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        known = sent.value.get
        for batch in batches:
            size, which, often, at = [], [], [], [0]
            for text in _raw(batch.column(1)):
                count: Counter[bytes] = Counter()
                for piece in terms(text or b""):
                    count.update(piece)
                size.append(count.total())
                for word, times in count.items():
                    if (k := known(word)) is not None:
                        which.append(k)
                        often.append(times)
                at.append(len(which))
            offsets = pa.array(at, pa.int32())
            yield [batch.column(0), size, pa.ListArray.from_arrays(offsets, pa.array(which, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64()))]

    return saved(map_batches(docs, run, "id bigint, n bigint, which array<int>, often array<bigint>"), "hits")


def _holders(hits: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of ``size`` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(total)
        yield [some, total[some]]

    out = np.zeros(size, np.int64)
    counted = map_batches(hits.select("which"), run, "term int, held bigint").groupBy("term").agg(F.sum("held").alias("held"))
    for row in counted.collect():  # a row for each term of a block of items
        out[row["term"]] = row["held"]
    return out


class _Scorer:
    """Scores batches of documents for a block's items and keeps the best k of each."""

    def __init__(self, weights: np.ndarray, rests: list[list[int]], sums: list[list[int]], n: int, length: int, k: int):
        self.weights, self.rests, self.k, self.n, self.length = weights, rests, k, n, length
        self.terms = len(weights)
        level: list[int] = [0] * self.terms
        self.steps: dict[tuple[int, int], list[tuple[int, list[int]]]] = defaultdict(list)
        for at, parts in enumerate(sums):
            level.append(1 + max(level[p] for p in parts))
            self.steps[level[-1], len(parts)].append((self.terms + at, parts))
        self.plan = [(np.array([s for s, _ in made]), np.array([p for _, p in made])) for _, made in sorted(self.steps.items())]
        self.rows = self.terms + len(sums)
        self.batch = max(16, BATCH_BYTES // 8 // max(1, self.rows))
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in rests]

    def add(self, ids: np.ndarray, sizes: np.ndarray, owner: np.ndarray, which: np.ndarray, often: np.ndarray) -> None:
        """Documents by rank of id (``ids``), and their terms; ``owner`` numbers the documents."""
        norm = np.array([10 + 90 * s * self.n // self.length for s in sizes.tolist()], np.int64)
        score = self.weights[which] * (1_000_000_000 * often // (1000 * often + 8 * norm[owner]))
        for lo in range(0, len(ids), self.batch):
            hi = min(lo + self.batch, len(ids))
            a, b = np.searchsorted(owner, (lo, hi))
            rows = np.zeros((self.rows, hi - lo), np.int64)
            rows[which[a:b], owner[a:b] - lo] = score[a:b]
            for made, parts in self.plan:
                rows[made] = rows[parts[:, 0]]
                for part in parts.T[1:]:
                    rows[made] += rows[part]
            for item, rest in enumerate(self.rests):
                self._keep(item, rows[rest].sum(axis=0), ids[lo:hi])

    def _keep(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        had, held = self.best[item]
        least = had[-1] if len(had) == self.k else 1
        some = np.flatnonzero(score >= max(1, least))
        if len(some) > 4 * self.k:  # all that reach the k-th best of them, ties too
            among = score[some]
            some = some[among >= np.partition(among, len(among) - self.k)[len(among) - self.k]]
        if len(some):
            both, whose = np.concatenate([had, score[some]]), np.concatenate([held, ids[some]])
            first = np.lexsort((whose, -both))[:self.k]
            self.best[item] = both[first], whose[first]


#: Stands for a missing id in comparisons: after all others.
_NO_ID = np.iinfo(np.int64).max


def _scored(hits: DataFrame, graph, weights: np.ndarray, n: int, length: int, k: int) -> DataFrame:
    sent = hits.sparkSession.sparkContext.broadcast((weights, graph["items"], graph["rests"], graph["sums"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        own, items, rests, sums = sent.value
        scorer = _Scorer(own, rests, sums, n, length, k)
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            lists = batch.column(2)
            owner = np.repeat(np.arange(len(ids)), np.asarray(lists.value_lengths()))
            scorer.add(ids, batch.column(1).to_numpy(), owner, lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy())
        found = [(item, d if d != _NO_ID else None, s) for item, (score, ids) in zip(items, scorer.best) for s, d in zip(score.tolist(), ids.tolist())]
        yield [pa.array([f[j] for f in found], pa.int64()) for j in range(3)]

    return map_batches(hits, run, "item_id bigint, doc_id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    k: int = BEST, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its k best documents with a score above 0: item_id, rank, doc_id, score; equal scores
    by ascending id.

    Ids are whole numbers or text of them. Rows that repeat an item id, null too, are one item with
    all their terms; items without a term have no rows. Each row of ``docs`` is a document, so a
    repeated id can be listed more than once; documents without an id come after equal ones with one.
    Null, empty and termless texts count as no document. No documents or items, no rows.
    """
    spark = docs.sparkSession
    wanted = saved(item_terms(items, item_col, item_text), "item-terms")
    blocks = math.ceil(wanted.count() / block_terms)
    graphs = _graph(wanted.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))))
    given = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for block in range(blocks):
        graph = graphs.where(F.col("block") == block).first()
        if graph is None:
            continue
        hits = _hits(given, [bytes(w) for w in graph["terms"]])
        totals = hits.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("length")).first()
        if not totals["n"]:
            break
        held = _holders(hits, len(graph["terms"])).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * totals["n"] + 2) / (2 * h + 1))) for h in held], np.int64)
        found = found.unionByName(saved(_scored(hits, graph, weights, totals["n"], totals["length"], k), "best"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
