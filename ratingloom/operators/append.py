"""Adding rating rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_ratings(ratings: DataFrame, new: DataFrame, on_conflict: str = "keep") -> DataFrame:
    """All old and new rows, matched by column name.

    ``keep`` leaves repeated (user, item) pairs in, each weighs in the fit. ``latest`` keeps one row
    per pair: a new one before any old one, then the newer by ``rated_at``, then the higher rating.
    """
    if on_conflict == "keep":
        return ratings.unionByName(new)
    if on_conflict != "latest":
        raise ValueError(f"unknown conflict rule {on_conflict!r}")
    old = ratings.withColumn("batch", F.lit(0))
    return latest_ratings(old.unionByName(new.withColumn("batch", F.lit(1))), "batch")


def latest_ratings(ratings: DataFrame, *before: str) -> DataFrame:
    """One row per pair, the largest by the columns ``before``, then time, then rating. A maximum,
    not a window: rows of a pair are reduced before the shuffle, so a pair that holds much of the
    table is never sorted in one task."""
    newest = F.max(F.struct(*before, "rated_at", "rating")).alias("newest")
    return ratings.groupBy("user_id", "item_id").agg(newest).select(
        "user_id", "item_id", "newest.rating", "newest.rated_at"
    )
