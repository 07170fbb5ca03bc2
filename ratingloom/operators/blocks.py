"""Scores of all users and items as products of factor blocks, without pairs that are left out.

Users and items are dealt into blocks by a hash of their id. A cell is a pair of blocks; it gets the
factors of both and those left-out pairs that lie in it, so a user who has rated a large part of the
catalogue is spread over the item blocks like the items themselves. One task goes through the cells
of a user block and carries along the n best of each user: what the last of them scores bounds how
short an item may be that is still looked at, and only the lists themselves leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.factorize import factors
from ratingloom.workspace import findable

#: Ids of a block, on average. A cell's left-out pairs are at most their product.
USER_BLOCK, ITEM_BLOCK = 2048, 65_536
#: User blocks, each of which meets every item: beyond this they grow instead, and the rows shuffled
#: stay a fixed multiple of the ids.
GRID = 24
#: Numbers of the lists that one task carries, at most; beyond this there are more user blocks.
CARRIED = 1 << 22
#: Scores held at once, at most, and those of one user: a few hundred KB stay in a core's cache.
SCORES, WIDTH = 1 << 17, 512
#: Bytes of ids and factors that move as one row, about.
PACK = 4096

_USER, _PAIR, _ITEM = 0, 1, 2
_LISTS = "user_id bigint, rank int, item_id bigint, score float"
_FOUND = pa.schema([("user_id", pa.int64()), ("rank", pa.int32()), ("item_id", pa.int64()), ("score", pa.float32())])


def best_outside(
    model: ALSModel, n: int, left_out: DataFrame, users: DataFrame | None = None,
    user_block: int = USER_BLOCK, item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """``user_id, rank, item_id, score``: for each user of the model, or each of ``users`` it has,
    the n best items but those paired with the user in ``left_out(user_id, item_id)``. Equal scores
    go by item id. Users without an item left have no rows."""
    asked = factors(model, "user")
    if users is not None:
        asked = asked.join(users.select("user_id"), "user_id", "left_semi")
        left_out = left_out.join(users.select("user_id"), "user_id", "left_semi")
    n_users, n_items, rank = asked.count(), model.itemFactors.count(), model.rank
    n = min(n, n_items)
    if not n_users or n < 1:
        return asked.sparkSession.createDataFrame([], _LISTS)
    u = max(min(-(-n_users // user_block), GRID), -(-n_users * n // CARRIED))
    i = -(-n_items // item_block)
    cells = _cells(asked, factors(model, "item"), left_out, u, i, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _lists(batches, n, rank)

    cells = cells.repartitionById(u, "ublock").sortWithinPartitions("ublock", "iblock", "kind")
    return findable(cells).mapInArrow(run, _LISTS)


def _cells(users: DataFrame, items: DataFrame, left_out: DataFrame, u: int, i: int, rank: int) -> DataFrame:
    """``ublock, iblock, kind, user_id, item_id, packed``: the users once, before all item blocks;
    the items once for every user block; each left-out pair once. Users and items come as packs."""
    def block(key: str, blocks: int):
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")

    none = [F.lit(None).cast("bigint").alias(c) for c in ("user_id", "item_id")]
    left = _packs(users.select(block("user_id", u).alias("block"), "user_id", "user_factor"), rank)
    left = left.select(F.col("block").alias("ublock"), F.lit(-1).alias("iblock"), F.lit(_USER).alias("kind"), *none, "packed")
    right = _packs(items.select(block("item_id", i).alias("block"), "item_id", "item_factor"), rank)
    every = F.explode(F.sequence(F.lit(0), F.lit(u - 1)))
    right = right.select(every.alias("ublock"), F.col("block").alias("iblock"), F.lit(_ITEM).alias("kind"), *none, "packed")
    pairs = left_out.select("user_id", "item_id").where("user_id is not null and item_id is not null").distinct()
    pairs = pairs.select(block("user_id", u).alias("ublock"), block("item_id", i).alias("iblock"), F.lit(_PAIR).alias("kind"), "user_id", "item_id", F.lit(None).cast("binary").alias("packed"))
    return left.unionByName(right).unionByName(pairs)


def _record(rank: int) -> np.dtype:
    return np.dtype([("id", np.int64), ("factor", np.float32, (rank,))])


def _packs(rows: DataFrame, rank: int) -> DataFrame:
    """``block, packed``: rows of block, id and factor as records of one block each, some KB of them
    to a row."""
    record = _record(rank)
    size = max(1, PACK // record.itemsize)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, ids, factor = batch.columns
            block, made = block.to_numpy(), np.empty(batch.num_rows, record)
            made["id"], made["factor"] = ids.to_numpy(), factor.flatten().to_numpy().reshape(-1, rank)
            order = np.argsort(block, kind="stable")
            block, made = block[order], made[order]
            starts = [lo for a, b in _runs(block) for lo in range(a, b, size)]
            stops = [*starts[1:], len(block)]
            packed = pa.array([made[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(block[starts], pa.int32()), packed], ["block", "packed"])

    return findable(rows).mapInArrow(pack, "block int, packed binary")


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of rows with equal values begin and end."""
    n = len(columns[0])
    edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    bounds = [0, *edge.tolist(), n]
    return list(zip(bounds[:-1], bounds[1:])) if n else []


def _lists(batches: Iterator[pa.RecordBatch], n: int, rank: int) -> Iterator[pa.RecordBatch]:
    """The lists of each user block, from its users, then cell by cell its left-out pairs and items."""
    at, block, users, items, pairs = (None, None), None, [], [], []
    for batch in batches:
        ublocks, iblocks, kinds = (batch.column(k).to_numpy() for k in ("ublock", "iblock", "kind"))
        for lo, hi in _runs(ublocks, iblocks, kinds):
            ublock, iblock, kind, rows = ublocks[lo], iblocks[lo], kinds[lo], batch.slice(lo, hi - lo)
            if at != (ublock, iblock):
                if block is None and users:
                    block, users = _Block(_unpacked(users, rank), n), []
                if block is not None and items:
                    block.meet(_unpacked(items, rank), pairs)
                items, pairs = [], []
                if block is not None and at[0] != ublock:
                    yield from block.found()
                    block = None
                at = (ublock, iblock)
            if kind == _PAIR:
                pairs.append((rows.column("user_id").to_numpy(), rows.column("item_id").to_numpy()))
            else:
                (users if kind == _USER else items).append(b"".join(rows.column("packed").to_pylist()))
    if block is not None:
        if items:
            block.meet(_unpacked(items, rank), pairs)
        yield from block.found()


def _unpacked(packs: list[bytes], rank: int) -> np.ndarray:
    """Records in order of id, but those whose scores can't be finite."""
    rows = np.frombuffer(b"".join(packs), _record(rank))
    rows = rows[np.isfinite(rows["factor"]).all(axis=1)]
    return rows[np.argsort(rows["id"])]


class _Block:
    """Users of a block, each with the n best of the items met so far, best first."""

    def __init__(self, users: np.ndarray, n: int):
        self.ids, self.factors, self.n = users["id"].copy(), users["factor"].copy(), n
        # what a product rounds off is far less than what lengths are raised by
        self.lengths = np.linalg.norm(self.factors.astype(np.float64), axis=1) * (1 + 1e-6 * (10 + self.factors.shape[1]))
        self.scores = np.full((len(users), n), -np.inf, np.float32)
        self.items = np.zeros((len(users), n), np.int64)
        self.held = np.empty(max(1, SCORES), np.float32)

    def meet(self, items: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Takes in the items of a cell, but for the cell's left-out pairs of user and item ids."""
        if not len(self.ids) or not len(items):
            return
        masked_users, masked_items = self._positions(items["id"], pairs)
        width = max(1, min(WIDTH, SCORES))
        high, across = max(1, SCORES // width), -(-len(items) // width)
        # longest items first, in runs of ``width``; within a run by id, for equal scores
        lengths = -np.linalg.norm(items["factor"].astype(np.float64), axis=1)
        order = np.argsort(lengths, kind="stable")
        lengths = lengths[order]
        order = order[np.lexsort((order, np.arange(len(order)) // width))]
        ids, columns = items["id"][order], np.ascontiguousarray(items["factor"][order].T)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        reach = self._reach(slice(None), lengths)
        order = np.argsort(-reach, kind="stable")[:np.count_nonzero(reach)]
        # left-out pairs by the tile of scores that they lie in
        row = np.full(len(self.ids), -1)
        row[order] = np.arange(len(order))
        masked_rows, masked_columns = row[masked_users], place[masked_items]
        tile = np.where(masked_rows < 0, -1, masked_rows // high * across + masked_columns // width)
        by_tile = np.argsort(tile, kind="stable")
        tile, masked_rows, masked_columns = tile[by_tile], masked_rows[by_tile], masked_columns[by_tile]
        for lo in range(0, len(order), high):
            users = order[lo:lo + high]
            own, least, found, n_found = self.factors[users], self.scores[users, -1], [], 0
            left, stop = 0, int(reach[users[0]])
            a, b = np.searchsorted(tile, (lo // high * across, (lo // high + 1) * across))
            has_masked = a < b
            while left < stop:
                right = min(left + width, len(ids))
                scores = self.held[:len(users) * (right - left)].reshape(len(users), right - left)
                np.matmul(own, columns[:, left:right], out=scores)
                if has_masked:
                    at = lo // high * across + left // width
                    a, b = np.searchsorted(tile, (at, at + 1))
                    scores[masked_rows[a:b] - lo, masked_columns[a:b] - left] = -np.inf
                hit = np.flatnonzero(~(scores.max(axis=1) < least))
                if len(hit):
                    some = scores[hit]
                    r, c = np.nonzero(~(some < least[hit, None]))
                    if len(r) > 4 * self.n * len(hit):
                        r, c = _largest(some, self.n)
                    value = some[r, c]
                    finite = np.isfinite(value)
                    found.append((hit[r[finite]], ids[left + c[finite]], value[finite]))
                    n_found += len(found[-1][0])
                left = right
                if n_found >= self.n * len(users):
                    self._take(users, found)
                    least, found, n_found = self.scores[users, -1], [], 0
                    stop = min(stop, int(self._reach(users, lengths).max()))
            if n_found:
                self._take(users, found)

    def _positions(self, items: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Left-out pairs as positions; pairs of ids that the model has no factors of don't matter."""
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair_users, pair_items = (np.concatenate(x) for x in zip(*pairs))
        at_user, at_item = np.searchsorted(self.ids, pair_users), np.searchsorted(items, pair_items)
        known = (self.ids[np.minimum(at_user, len(self.ids) - 1)] == pair_users) & (items[np.minimum(at_item, len(items) - 1)] == pair_items)
        return at_user[known], at_item[known]

    def _reach(self, users: np.ndarray | slice, lengths: np.ndarray) -> np.ndarray:
        """How many of the items, longest first, may score as high as each user's last: a product is
        at most that of the lengths. ``lengths`` come negated, so that they rise."""
        last = self.scores[users, -1].astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            needed = np.where(last < 1e-30, 0.0, last / self.lengths[users])
        return np.searchsorted(lengths, -needed, side="right")

    def _take(self, users: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Puts found items, as rows of ``users``, ids and scores, into the lists."""
        row, item, score = (np.concatenate(x) for x in zip(*found))
        touched, row = np.unique(row, return_inverse=True)
        users = users[touched]
        row = np.concatenate([np.repeat(np.arange(len(users)), self.n), row])
        item = np.concatenate([self.items[users].ravel(), item])
        score = np.concatenate([self.scores[users].ravel(), score])
        order = np.lexsort((item, -score, row))
        first = np.searchsorted(row[order], np.arange(len(users)))
        kept = order[first[:, None] + np.arange(self.n)]
        self.items[users], self.scores[users] = item[kept], score[kept]

    def found(self) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 16) // self.n)
        for lo in range(0, len(self.ids), step):
            scores = self.scores[lo:lo + step]
            row, column = np.nonzero(scores > -np.inf)
            yield pa.RecordBatch.from_arrays([
                pa.array(self.ids[lo + row]), pa.array((column + 1).astype(np.int32)),
                pa.array(self.items[lo + row, column]), pa.array(scores[row, column]),
            ], schema=_FOUND)


def _largest(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's n largest finite scores are; of equal ones the first."""
    width, groups = scores.shape[1], 16 * n
    wanted = np.isfinite(scores)
    if width > n:
        tops = np.where(wanted, scores, -np.inf)
        if width >= 4 * groups:
            # n of the groups hold a score this high each, so the n largest are as high or higher
            tops = tops[:, :width // groups * groups].reshape(len(scores), groups, -1).max(axis=2)
        wanted &= scores >= np.partition(tops, tops.shape[1] - n, axis=1)[:, tops.shape[1] - n, None]
    row, column = np.nonzero(wanted)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.arange(len(row)) - np.searchsorted(row, row) < n
    return row[first], column[first]
