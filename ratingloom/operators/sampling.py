"""Items to rate, and the train/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.config import SAMPLE_SEED, SplitConfig
from ratingloom.functions import hash_bucket, sample_key


def sample_items(pool: DataFrame, n: int = 1, seed: int = SAMPLE_SEED) -> DataFrame:
    """n items of a pool (the popular list or the whole catalogue) in seeded random order.
    Never empty while the pool is not; another seed gives another draw."""
    drawn = pool.select("item_id", "title").orderBy(sample_key(seed, "item_id"), "item_id")
    return drawn.limit(n)


def sample_fraction(pool: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """A Bernoulli sample without replacement."""
    return pool.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_ratings(
    ratings: DataFrame, config: SplitConfig = SplitConfig(), method: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    """Train and test ratings.

    ``hash`` decides by the content of (user, item): no shuffle, and the same rows land on the
    same side under any partitioning, after a retry and after more ratings are appended.
    ``random`` is Spark's seeded row split, which depends on row order.
    """
    if method == "random":
        share = config.train_buckets / config.buckets
        train, test = ratings.randomSplit([share, 1 - share], seed=config.seed)
        return train, test
    if method != "hash":
        raise ValueError(f"unknown split method {method!r}")
    part = split_part(config)
    return ratings.filter(part == "train"), ratings.filter(part == "test")


def split_part(config: SplitConfig = SplitConfig()) -> Column:
    """'train' or 'test', by the content of (user, item)."""
    bucket = hash_bucket(config.seed, config.buckets, "user_id", "item_id")
    return F.when(bucket < config.train_buckets, "train").otherwise("test")


def split_stats(ratings: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """``part, n, sum_rating`` of the hash split, in one pass."""
    return ratings.groupBy(split_part(config).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("sum_rating")
    )
