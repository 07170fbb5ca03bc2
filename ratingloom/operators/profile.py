"""Counts and popularity of the loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.config import POPULAR_LIMIT


def rated_items(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every rating with its item's title. How to join is left to Spark: it broadcasts the
    items only below its size threshold, and splits hot items of a sort-merge join."""
    titles = items.select("item_id", "title")
    return ratings.join(titles, "item_id").select("user_id", "item_id", "title", "rating")


def item_popularity(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """Number of ratings per item and title.

    Ratings are counted per item before the join, so it meets one row per item however hot the
    item is. An id listed more than once in the catalogue counts once per listing, as it would
    in a join of the raw rows.
    """
    return counted_items(items, ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")))


def counted_items(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``item_id, title, count`` from counts ``item_id, n`` that are there already."""
    return (
        counts.join(items.select("item_id", "title"), "item_id")
        .groupBy("item_id", "title")
        .agg(F.sum("n").alias("count"))
    )


def popular_items(items: DataFrame, ratings: DataFrame, k: int = POPULAR_LIMIT) -> DataFrame:
    """The k most rated items; equal counts go by item id."""
    return most_rated(item_popularity(items, ratings), k)


def most_rated(popularity: DataFrame, k: int = POPULAR_LIMIT) -> DataFrame:
    return popularity.orderBy(F.desc("count"), "item_id").limit(k)


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def max_user_id(ratings: DataFrame) -> DataFrame:
    """One row; 0 if there are no ratings."""
    return ratings.agg(F.coalesce(F.max("user_id"), F.lit(0).cast("bigint")).alias("max_user_id"))


def dataset_stats(items: DataFrame, ratings: DataFrame) -> DataFrame:
    """``n_items, n_ratings, n_users, max_user_id`` in one row, one pass over each table."""
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    n_items = items.agg(F.count(F.lit(1))).scalar()
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_ratings"),
        F.count("user_id").alias("n_users"),
        F.coalesce(F.max("user_id"), F.lit(0)).cast("bigint").alias("max_user_id"),
    ).select(n_items.alias("n_items"), "n_ratings", "n_users", "max_user_id")


def hottest_keys(ratings: DataFrame) -> DataFrame:
    """``max_user_rows, max_item_rows``: how many ratings the largest user and item hold."""

    def largest(key: str):
        sizes = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        most = F.coalesce(F.max("n"), F.lit(0)).cast("bigint")
        return sizes.agg(most.alias(f"max_{key[:4]}_rows"))

    users, items = largest("user_id"), largest("item_id")
    return users.select("max_user_rows", items.scalar().alias("max_item_rows"))
