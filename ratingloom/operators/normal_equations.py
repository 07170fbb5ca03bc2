"""Alternating least squares as joins and grouped sums.

For each user, the factors of the rated items give a small symmetric system: the sum of v v' plus
reg_param n I on the left, the sum of rating v on the right; for each item likewise. Sums have
partial results, so a key that holds a third of the ratings is summed up in every task that meets
it, and only its sums move. This is the route for such data; MLlib's is faster without hot keys.

A half-round is computed in slices of its keys, and what a slice has shuffled is freed when its
factors are written: disk holds the pairs, the last factors and one slice's rows at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.config import AlsConfig
from ratingloom.sources.staging import stage
from ratingloom.workspace import freed_shuffles, fresh_path, remove

#: Pairs that a half-round brings together at once, on average; more are taken slice by slice.
SLICE_PAIRS = 1 << 24


def alternate(ratings: DataFrame, config: AlsConfig) -> tuple[DataFrame, DataFrame]:
    """``user_id, features`` and ``item_id, features`` after ``max_iter`` rounds, users last.

    Every half-round is a written table, which keeps the lineage short and lets a job resume
    from the last one when executors are lost. Those of earlier rounds are removed.
    """
    if config.reg_param <= 0:
        raise ValueError("grouped sums need a positive reg_param")
    spark = ratings.sparkSession
    folder = fresh_path(spark, "normal-equations")
    with freed_shuffles(spark):
        counted = stage(counted_pairs(ratings), f"{folder}/counted")
        slices = max(1, -(-counted.count() // SLICE_PAIRS))
        pairs = stage_slices(dealt_pairs(counted, config.hot_pairs), slices, f"{folder}/pairs")
        remove(spark, f"{folder}/counted")
        users = starting_factors(pairs, "user_id", config)
        for turn in range(config.max_iter):
            items = stage_half_round(pairs, users, "item_id", config, slices, f"{folder}/items-{turn}")
            users = stage_half_round(pairs, items, "user_id", config, slices, f"{folder}/users-{turn}")
            if turn:  # nothing reads those of the round before any more
                remove(spark, f"{folder}/items-{turn - 1}", f"{folder}/users-{turn - 1}")
        remove(spark, f"{folder}/pairs")
    return users, items


def stage_slices(pairs: DataFrame, slices: int, path: str) -> DataFrame:
    """The pairs with ``user_id_slice`` and ``item_id_slice``, in files by both, so that a slice of
    either side is read alone."""
    names = {f"{key}_slice": F.pmod(F.xxhash64(key), F.lit(slices)).cast("int") for key in ("user_id", "item_id")}
    pairs = pairs.withColumns(names)
    writer = pairs.write.partitionBy(*names) if slices > 1 else pairs.write
    writer.parquet(path)
    return pairs.sparkSession.read.schema(pairs.schema).parquet(path)


def stage_half_round(
    pairs: DataFrame, known: DataFrame, key: str, config: AlsConfig, slices: int, path: str
) -> DataFrame:
    """``half_round`` slice by slice, each written before the next begins."""
    paths = [f"{path}/slice-{k}" for k in range(slices)]
    for k, own in enumerate(paths):
        stage(half_round(pairs.filter(F.col(f"{key}_slice") == k), known, key, config), own)
    return pairs.sparkSession.read.parquet(*paths)


def weighted_pairs(ratings: DataFrame, hot_pairs: int) -> DataFrame:
    """One row per (user, item): ``n`` ratings adding up to ``total``, which weigh the same in
    the sums as the n rows would. ``user_id_hot`` and ``item_id_hot`` mark the large keys;
    ``user_id_piece`` and ``item_id_piece`` deal a large key's pairs into pieces of about
    ``hot_pairs`` by the other id (0 for the others)."""
    return dealt_pairs(counted_pairs(ratings), hot_pairs)


def counted_pairs(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")
    )


def dealt_pairs(pairs: DataFrame, hot_pairs: int) -> DataFrame:
    for key, other in (("user_id", "item_id"), ("item_id", "user_id")):
        sizes = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
        hot = sizes.filter(F.col("_size") > hot_pairs).select(
            key, F.ceil(F.col("_size") / F.lit(hot_pairs)).alias("_pieces")
        )
        piece = F.pmod(F.xxhash64(other), F.col("_pieces"))
        pairs = pairs.join(hot, key, "left").select(
            *pairs.columns,
            F.col("_pieces").isNotNull().alias(f"{key}_hot"),
            F.coalesce(piece, F.lit(0)).cast("int").alias(f"{key}_piece"),
        )
    return pairs


def starting_factors(pairs: DataFrame, key: str, config: AlsConfig) -> DataFrame:
    """Pseudo-random factors that depend on the seed and the id alone."""
    scale = float(2**63) * config.rank**0.5
    components = [
        (F.xxhash64(F.lit(config.seed), F.col(key), F.lit(k)) / F.lit(scale)).cast("float")
        for k in range(config.rank)
    ]
    return pairs.select(key).distinct().withColumn("features", F.array(*components))


def half_round(pairs: DataFrame, known: DataFrame, key: str, config: AlsConfig) -> DataFrame:
    """``key, features``: the best factors of one side given the other side's."""
    other = "item_id" if key == "user_id" else "user_id"
    piece = f"{key}_piece"
    rows = pairs.join(known, other).select(key, f"{key}_hot", piece, "n", "total", "features")
    # Sums are ten times the size of a row. Ordinary keys move their rows and are summed where
    # they arrive; hot keys move their rows by piece, each piece of about hot_pairs pairs is
    # summed where it arrives, and only the pieces' sums move on. So a hot key moves at most one
    # sum per piece, however many tasks its rows come from.
    ordinary = rows.filter(~F.col(f"{key}_hot")).repartition(key)
    hot = rows.filter(F.col(f"{key}_hot")).repartition(key, piece)
    systems = sums(ordinary, key, config.rank).unionByName(sums(hot, key, config.rank, piece))
    solved = solver(config.rank, config.reg_param)(F.col("n"), F.col("left"), F.col("right"))
    return systems.select(key, solved.alias("features"))


def sums(rows: DataFrame, key: str, rank: int, piece: str | None = None) -> DataFrame:
    """``key, n, left, right``: the upper triangle of the matrix by rows, and the vector. With
    ``piece``, each piece of a key is summed first and the key's sums are those of its pieces."""

    def factor(k: int) -> Column:
        return F.get("features", F.lit(k)).cast("double")

    triangle = [(i, j) for i in range(rank) for j in range(i, rank)]
    left = [F.sum(F.col("n") * factor(i) * factor(j)).alias(f"l{i}_{j}") for i, j in triangle]
    right = [F.sum(F.col("total") * factor(i)).alias(f"r{i}") for i in range(rank)]
    lefts, rights = [f"l{i}_{j}" for i, j in triangle], [f"r{i}" for i in range(rank)]
    grouped = rows.groupBy(key, *([piece] if piece else [])).agg(F.sum("n").alias("n"), *left, *right)
    if piece:
        grouped = grouped.groupBy(key).agg(*[F.sum(c).alias(c) for c in ["n", *lefts, *rights]])
    return grouped.select(key, "n", F.array(*lefts).alias("left"), F.array(*rights).alias("right"))


def solver(rank: int, reg_param: float):
    """Solves a batch of systems at once."""
    rows, columns = np.triu_indices(rank)

    @F.pandas_udf("array<float>")
    def solve(n: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        if n.empty:
            return pd.Series([], dtype=object)
        matrices = np.empty((len(n), rank, rank))
        matrices[:, rows, columns] = matrices[:, columns, rows] = np.stack(left.to_numpy())
        matrices += reg_param * n.to_numpy()[:, None, None] * np.eye(rank)
        vectors = np.stack(right.to_numpy())[:, :, None]
        return pd.Series(list(np.linalg.solve(matrices, vectors)[:, :, 0].astype("float32")))

    return solve
