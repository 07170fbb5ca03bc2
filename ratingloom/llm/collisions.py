"""Approximate nearest neighbours by collision counting on query-centred windows.

The index deals all vectors at random over shards. A shard keeps, for each of PROJECTIONS random
directions (rows of random orthonormal bases), its vectors' projections as one sorted array. A query
opens a window around its own projection in every array; a vector that lies in the window collides.
Vectors that collide in THRESHOLD of the arrays or more are verified by their exact distance. The
windows grow by a fixed factor (virtual rehashing) until they are so wide that a vector as near as
the worst of the k best found so far would have collided often enough with probability CONFIDENCE;
then no more than that share of better ones can have been missed. No number of candidates is set.

Shards are searched in waves of growing size. The k-th distance after a wave bounds the next one, so
that a shard of a later wave verifies and returns little. Queries are taken in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.arrow import findable
from ratingloom.llm.common import saved

NEIGHBOURS = 10
PROJECTIONS = 128
#: Share of the arrays in which a vector must collide to be verified.
THRESHOLD = 0.8
#: Probability that a vector as near as the k-th best is verified.
CONFIDENCE = 0.95
#: Factors by which windows grow while the k-th most colliding vector is far from the threshold, and
#: near it; the first half-width as a share of the projections' spread.
FAR, NEAR, FIRST = 1.5, 1.1, 0.05
#: Vectors of a shard, queries of a block, shards of the first wave, growth of the waves.
SHARD_ROWS, BLOCK_ROWS, FIRST_WAVE, WAVES = 8192, 8192, 2, 16
#: Vectors verified at once in a task.
VERIFIED = 16_384


def directions(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    """``count`` directions of length sqrt(dim): rows of as many random orthonormal bases as needed."""
    dice, out = np.random.default_rng(20_000 + dim), []
    while sum(map(len, out)) < count:
        basis, upper = np.linalg.qr(dice.standard_normal((dim, dim))) if dim <= 4 * count else np.linalg.qr(dice.standard_normal((dim, count)))
        out.append((basis * np.sign(np.diag(upper))).T * math.sqrt(dim))
    return np.concatenate(out)[:count]


def needed_width(count: int = PROJECTIONS, threshold: float = THRESHOLD, confidence: float = CONFIDENCE) -> float:
    """Half-width of the windows, in units of a vector's distance, at which it collides in
    ``threshold`` of ``count`` projections with probability ``confidence``."""
    least = math.ceil(threshold * count)

    def passes(width: float) -> float:
        p = math.erf(width / math.sqrt(2))
        return sum(math.comb(count, k) * p ** k * (1 - p) ** (count - k) for k in range(least, count + 1))

    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if passes(middle) >= confidence else (middle, high)
    return high


class Shard:
    """Vectors of one shard with the sorted arrays of their projections."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray, order: np.ndarray):
        self.vectors, self.sorted, self.order = vectors, projected, order
        #: what the projections of equal vectors can differ by
        self.slack = np.float32(1e-6 * np.abs(projected[:, [0, -1]]).max())

    @staticmethod
    def built(vectors: np.ndarray) -> Shard:
        projected = directions(vectors.shape[1]) @ vectors.T.astype(float)
        order = np.argsort(projected, axis=1, kind="stable").astype(np.uint16)
        return Shard(vectors, np.take_along_axis(projected, order.astype(np.int64), axis=1).astype(np.float32), order)

    def collisions(self, centre: np.ndarray, width: float) -> np.ndarray:
        """In how many arrays each vector lies within ``width`` of the query's projection."""
        size = len(self.vectors)
        inside, outside, full = [], [], 0
        low, high = centre - (width + self.slack), centre + (width + self.slack)
        for values, order, first, last in zip(self.sorted, self.order, low, high):
            lo, hi = values.searchsorted(first), values.searchsorted(last, "right")
            if 2 * (hi - lo) <= size:
                inside.append(order[lo:hi])
            else:  # fewer lie outside
                full += 1
                outside += [order[:lo], order[hi:]]
        out = np.full(size, full, np.int64)
        if inside:
            out += np.bincount(np.concatenate(inside), minlength=size)
        if outside:
            out -= np.bincount(np.concatenate(outside), minlength=size)
        return out

    def distances(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        found = [np.sqrt(((self.vectors[which[lo:lo + VERIFIED]].astype(float) - query) ** 2).sum(axis=1)) for lo in range(0, len(which), VERIFIED)]
        return np.concatenate(found) if found else np.zeros(0)

    def nearest(self, query: np.ndarray, own: int, bound: float, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and distances of up to k vectors other than ``own`` (-1: none) within
        ``bound``, found by widening windows, and how many were verified."""
        centre = (directions_of(len(query)) @ query).astype(np.float32)
        enough, least = _WIDTH, math.ceil(THRESHOLD * PROJECTIONS)
        spread = float(self.sorted[:, -1].max() - self.sorted[:, 0].min()) or 1.0
        width = FIRST * spread
        if bound < math.inf:  # wide enough for the bound at once: it is the worst so far
            width = bound * enough
        seen = np.zeros(len(self.vectors), bool)
        best, at = np.zeros(0), np.zeros(0, np.int64)
        if own >= 0:
            seen[own] = True
        while True:
            hits = self.collisions(centre, width)
            fresh = np.flatnonzero((hits >= least) & ~seen)
            seen[fresh] = True
            far = self.distances(query, fresh)
            best, at = np.concatenate([best, far]), np.concatenate([at, fresh])
            keep = best <= bound
            best, at = best[keep], at[keep]
            if len(best) > k:
                first = np.lexsort((ids[at], best))[:k]
                best, at = best[first], at[first]
            worst = float(best.max()) if len(best) >= k else bound
            if width >= enough * worst or seen.all():
                return at, best, int(seen.sum())
            close = np.partition(hits, max(0, len(hits) - k))[max(0, len(hits) - k)] > 0.8 * least
            width = min(width * (NEAR if close else FAR), enough * worst)


_WIDTH = needed_width()
_DIRECTIONS: dict[int, np.ndarray] = {}


def directions_of(dim: int) -> np.ndarray:
    if dim not in _DIRECTIONS:
        _DIRECTIONS.clear()
        _DIRECTIONS[dim] = directions(dim)
    return _DIRECTIONS[dim]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row (a number of its own for every row), id, dim and vector of the rows that take part."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    table = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    good = F.forall("vector", entry) & F.exists("vector", lambda x: x != 0)
    return table.where(F.col("id").isNotNull() & good).withColumn("dim", F.size("vector"))


_INDEX = "shard string, projection int, sorted binary, places binary"


def _build(rows: DataFrame) -> DataFrame:
    """The index: per shard a row for each projection, with the sorted values and whose they are."""

    def run(group: pa.Table) -> pa.Table:
        vectors = np.asarray(group.column("vector").combine_chunks().flatten(), float).reshape(group.num_rows, -1)
        shard = Shard.built(vectors)
        name, count = group.column("shard")[0].as_py(), len(shard.sorted)
        return pa.table({
            "shard": [name] * (count + 1), "projection": pa.array([*range(count), -1], pa.int32()),
            "sorted": [*(x.tobytes() for x in shard.sorted), vectors.tobytes()],
            "places": [*(x.tobytes() for x in shard.order), np.array([group.column("row").to_numpy(), group.column("id").to_numpy()]).tobytes()],
        })

    return saved(findable(rows).groupBy("shard").applyInArrow(run, _INDEX), "collision-index")


def _loaded(index: pa.Table) -> tuple[Shard, np.ndarray, np.ndarray]:
    by = {p: (s, o) for p, s, o in zip(*(index.column(c).to_pylist() for c in ("projection", "sorted", "places")))}
    rows, ids = np.frombuffer(by[-1][1], np.int64).reshape(2, -1)
    arrays = [by[p] for p in range(len(by) - 1)]
    vectors = np.frombuffer(by[-1][0], float).reshape(len(ids), -1)
    projected = np.stack([np.frombuffer(s, np.float32) for s, _ in arrays])
    return Shard(vectors, projected, np.stack([np.frombuffer(o, np.uint16) for _, o in arrays])), rows, ids


def _search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Every query's up to k nearest within its bound in the shard it is paired with."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[list] = [[], [], [], []]
        if index.num_rows and queries.num_rows:
            shard, rows, ids = _loaded(index)
            place = {row: at for at, row in enumerate(rows.tolist())}
            columns = (queries.column(c).to_pylist() for c in ("row", "id", "bound", "vector"))
            for row, query_id, bound, vector in zip(*columns):
                at, far, _ = shard.nearest(np.array(vector), place.get(row, -1), math.inf if bound is None else bound, k, ids)
                found[0] += [row] * len(at)
                found[1] += [query_id] * len(at)
                found[2] += ids[at].tolist()
                found[3] += far.tolist()
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64()), pa.array(found[3], pa.float64())], ["row", "query_id", "vec_id", "score"])

    schema = "row bigint, query_id bigint, vec_id bigint, score double"
    return index.groupBy("shard").cogroup(queries.groupBy("shard")).applyInArrow(run, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per query the k nearest other rows found: query_id, rank, vec_id, score (the Euclidean
    distance in double precision), nearest first, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``; ids are whole numbers or text of them. Rows
    without an id, and vectors that are null, empty, zero or hold null or non-finite entries, take no
    part. Every row is a vector of its own: rows that repeat an id are all candidates and each is a
    query where the condition holds, so a query's own row alone is left out and its copies are found
    at distance 0. Vectors of different lengths never meet. A table without usable rows gives none.
    """
    spark = vectors.sparkSession
    rows = saved(usable(vectors, id_col, vector_col), "vectors")
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = rows.join(sizes, "dim").withColumn("number", F.pmod(F.xxhash64("row"), "shards"))
    index = _build(dealt.select("row", "id", "vector", F.concat_ws("-", "dim", "number").alias("shard")))

    asked = rows.where(is_query)
    blocks = max(1, math.ceil(asked.count() / BLOCK_ROWS))
    most = sizes.agg(F.max("shards").alias("most")).first()["most"] or 0
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)))
    found: DataFrame | None = None
    for block in range(blocks if most else 0):
        queries = asked.where(F.col("block") == block).join(sizes, "dim")
        best, low, high = None, 0, FIRST_WAVE
        while low < most:
            numbers = F.sequence(F.lit(low).cast("bigint"), F.least(F.lit(high).cast("bigint"), "shards") - 1)
            bound = best.where(F.col("rank") == k).select("row", F.col("score").alias("bound")) if best is not None else None
            wave = queries.join(bound, "row", "left") if bound is not None else queries.withColumn("bound", F.lit(None).cast("double"))
            wave = wave.where(F.col("shards") > low).withColumn("number", F.explode(numbers))
            wave = wave.select("row", "id", "vector", "bound", F.concat_ws("-", "dim", "number").alias("shard"))
            part = index.where(F.substring_index("shard", "-", -1).cast("bigint").between(low, high - 1)) if high < most or low else index
            new = _search(part, wave, k)
            best = saved(_best(new if best is None else new.unionByName(best.drop("rank")), k), "nearest")
            low, high = high, high + (high - low) * WAVES
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
