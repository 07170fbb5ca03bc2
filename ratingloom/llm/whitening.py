"""Embedding whitening: principal components by QDWH spectral divide and conquer.

Spark sums what grows with the rows: counts and entries, then centred products, then the moments of
the whitened values. What is left is one matrix of dimension by dimension. The polar factor U of
the matrix, shifted by the mean of its eigenvalues, gives (U + I) / 2, the projector onto all that
lies above the shift; bases of its range and of its complement split the matrix in two, and each
part is split again until a part has a single eigenvalue. The polar factor comes from the
dynamically weighted Halley iteration in its form by QR.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import saved

COMPONENTS = 8
#: An entry c stands as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries up to this can be written as such a number in 64 bits.
LARGEST = 2.0 ** 52
#: Rows that are worked on at once in a task.
ROWS = 4096
_LONG = 2 ** 63 - 1


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal (for singular matrices: partly isometric) polar factor of a symmetric matrix."""
    size = len(a)
    norm = np.linalg.norm(a)
    if not norm:
        return np.eye(size)
    x, low, eye = a / norm, np.finfo(float).eps / size, np.eye(size)
    for _ in range(60):
        square = low * low
        d = (4 * (1 - square) / (square * square)) ** (1 / 3)
        root = math.sqrt(1 + d)
        first = root + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        second = (first - 1) ** 2 / 4
        third = first + second - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(third) * x, eye]))
        new = second / third * x + (first - second / third) / math.sqrt(third) * q[:size] @ q[size:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (first + second * square) / (1 + third * square))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 1e-15 and moved < 1e-13 * math.sqrt(size) * 10:
            break
    return x


def _range_of(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement."""
    dice = np.random.default_rng(len(projector))
    probe = projector @ dice.standard_normal((len(projector), rank))
    basis, _ = np.linalg.qr(projector @ np.linalg.qr(probe)[0])
    whole, _ = np.linalg.qr(np.hstack([basis, dice.standard_normal((len(projector), len(projector) - rank))]))
    return basis, whole[:, rank:]


def _split(a: np.ndarray, basis: np.ndarray, wanted: int, tiny: float) -> list[tuple[float, np.ndarray]]:
    """The ``wanted`` largest eigenvalues of ``basis' a basis`` with vectors of ``a``, largest first."""
    if wanted <= 0:
        return []
    part = basis.T @ a @ basis
    part, size = (part + part.T) / 2, len(part)
    mean = np.trace(part) / size
    centred = part - mean * np.eye(size)
    if size == 1 or np.linalg.norm(centred) <= tiny:  # one eigenvalue: any basis will do
        return [(float(basis[:, k] @ a @ basis[:, k]), basis[:, k]) for k in range(min(size, wanted))]
    spread = np.linalg.norm(centred) / math.sqrt(size)
    for step in range(20):
        # the mean lies between the ends; beside an eigenvalue that equals it the shift moves a little
        shift = ((step + 1) // 2) * (0.01 if step % 2 else -0.01) * spread
        factor = polar(centred - shift * np.eye(size))
        rank = round(float(np.trace(factor) + size) / 2)
        projector = (factor + np.eye(size)) / 2
        if 0 < rank < size and np.linalg.norm(projector @ projector - projector) < 1e-8:
            break
    above, below = _range_of(projector, rank)
    found = _split(a, basis @ above, wanted, tiny)
    return found + _split(a, basis @ below, wanted - len(found), tiny)


def eigenpairs(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix and their unit vectors as columns."""
    size = len(a)
    tiny = 4 * np.finfo(float).eps * np.linalg.norm(a) * math.sqrt(size)
    found = sorted(_split(a, np.eye(size), min(wanted, size), tiny), key=lambda pair: -pair[0])
    if not found:
        return np.zeros(0), np.zeros((size, 0))
    vectors, _ = np.linalg.qr(np.array([v for _, v in found]).T)
    return np.array([e for e, _ in found]), vectors


def _vectors(batch: pa.RecordBatch, dim: int | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and x-vectors of the usable rows of a batch; of any length if ``dim`` is None."""
    lists = batch.column(1)
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    for length in (sorted(set(sizes.tolist()) - {0}) if dim is None else [dim]):
        chosen = np.flatnonzero(sizes == length)
        for lo in range(0, len(chosen), ROWS):
            some = pa.array(chosen[lo:lo + ROWS])
            entries = lists.take(some).flatten()
            values = np.asarray(entries.fill_null(math.nan), float).reshape(-1, length)
            good = (np.abs(values) < LARGEST).all(axis=1)
            yield batch.column(0).take(some).filter(pa.array(good)), np.floor(SCALE * values[good]).astype(np.int64) + SHIFT


def _moments(values: Iterator[tuple[np.ndarray, np.ndarray]], dim: int) -> np.ndarray:
    total = np.zeros((dim, dim))
    for left, right in values:
        total += left.T @ right
    return total


def _matrix(table: DataFrame, dim: int) -> np.ndarray:
    """The sum of all tasks' matrices, given as rows of (row, values)."""
    cells = table.select("row", F.posexplode("values").alias("at", "value")).groupBy("row", "at").agg(F.sum("value").alias("value"))
    out = np.zeros((dim, dim))
    for cell in cells.collect():  # dimension by dimension, whatever the number of rows
        out[cell["row"], cell["at"]] = cell["value"]
    return out


def _sums(table: DataFrame) -> tuple[int, np.ndarray]:
    """Number, and exact sum by dimension, of the x-vectors of the commonest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        number: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for ids, x in _vectors(batch, None):
                length = x.shape[1]
                number[length] = number.get(length, 0) + len(x)
                # two parts of 32 bits, so that no sum of a task leaves 64 bits
                halves = np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                total[length] = total[length] + halves if length in total else halves
        for length, n in number.items():
            yield [[length], [n], [total[length][0].tolist()], [total[length][1].tolist()]]

    tasks = saved(map_batches(table, run, "dim int, n bigint, high array<bigint>, low array<bigint>"), "whitening-sums")
    lengths = tasks.groupBy("dim").agg(F.sum("n").alias("n")).where("n > 0")
    best = lengths.orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not best:
        return 0, np.zeros(0)
    exact = F.sum(F.col("high").cast("decimal(38,0)")) * F.lit(2 ** 32).cast("decimal(12,0)") + F.sum(F.col("low").cast("decimal(38,0)"))
    entries = tasks.where(F.col("dim") == best[0]["dim"]).select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "both"))
    found = entries.select("at", "both.high", "both.low").groupBy("at").agg(exact.alias("total")).collect()
    return best[0]["n"], np.array([int(r["total"]) for r in sorted(found, key=lambda r: r["at"])], object)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[list, np.ndarray]:
    """sum((n * x - S)^2) of each row, exact, null beyond 64 bits; and x - S / n."""
    far = float(np.abs(x).max(initial=0)) * n + float(max((abs(s) for s in sums), default=0))
    if far * far * max(1, x.shape[1]) < _LONG / 2:
        apart = n * x - sums.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist(), apart / n
    apart = n * x.astype(object) - sums
    squares = [int(d) for d in (apart * apart).sum(axis=1)]
    return [d if d <= _LONG else None for d in squares], (apart / n).astype(float)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: id, component, n, deviation, whitened, explained and
    identity_error.

    Every row counts, repeated ids and vectors too, and rows without an id; ids are whole numbers or
    text of them. Rows whose vector is null or empty, holds null, non-finite or entries from 2^52 on,
    or hasn't the commonest length (of equally common ones the longest) are left out. Components
    without variance can't be whitened and are not returned; a table without usable vectors, or with
    equal ones only, has no rows. ``deviation`` is null where it exceeds 64 bits.
    """
    table = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = "id bigint, deviation bigint, whitened array<double>"
    spark = table.sparkSession
    n, sums = _sums(table)
    dim = len(sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        centred = (_deviations(x, n, sums)[1] for batch in batches for _, x in _vectors(batch, dim))
        total = _moments(((c, c) for c in centred), dim)
        yield [list(range(dim)), total.tolist()]

    if n:
        covariance = _matrix(map_batches(table, products, "row int, values array<double>"), dim) / n
        trace = float(np.trace(covariance))
        values, axes = eigenpairs((covariance + covariance.T) / 2, components)
        good = values > 1e-13 * max(trace, 0.0)
        values, axes = values[good], axes[:, good]
    else:
        values, axes, trace = np.zeros(0), np.zeros((0, 0)), 0.0
    count = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            for ids, x in _vectors(batch, dim) if count else ():
                deviation, centred = _deviations(x, n, sums)
                yield [ids, deviation, (centred @ axes / np.sqrt(values)).tolist()]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        def blocks():
            for batch in batches:
                if batch.num_rows:
                    values = np.asarray(batch.column(2).flatten(), float).reshape(-1, count)
                    values = np.hstack([values, np.ones((len(values), 1))])
                    yield values, values
        yield [list(range(count + 1)), _moments(blocks(), count + 1).tolist()]

    done = saved(map_batches(table, project, schema), "whitened") if count else spark.createDataFrame([], schema)
    error = 0.0
    if count:
        moments = _matrix(map_batches(done, second, "row int, values array<double>"), count + 1) / n
        means = moments[count, :count]
        error = float(np.abs(moments[:count, :count] - np.outer(means, means) - np.eye(count)).max())
    shares = F.array(*[F.lit(float(v / trace)) for v in values]) if count else F.array().cast("array<double>")
    rows = done.select("id", "deviation", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
