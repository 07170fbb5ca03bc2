"""Ratings submitted for known or new users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.registry import allocate_users
from ratingloom.sources.forms import parse_submissions


def submitting_users(
    submissions: DataFrame, users: DataFrame, mode: str = "exists", largest: int | None = None
) -> DataFrame:
    """``request_id, user_id, is_new`` for every ``request_id, user_id, fields`` submission,
    whether it has rated items or not."""
    return allocate_users(submissions.select("request_id", "user_id"), users, mode, largest)


def submitted_ratings(submissions: DataFrame, users: DataFrame) -> DataFrame:
    """``request_id, user_id, item_id, rating, reason`` under the final user ids."""
    parsed = parse_submissions(submissions.select("request_id", "fields"))
    return parsed.join(users.select("request_id", "user_id"), "request_id").select(
        "request_id", "user_id", "item_id", "rating", "reason"
    )


def submission_summary(submissions: DataFrame, users: DataFrame) -> DataFrame:
    """``request_id, user_id, is_new, n_rows``: rows counted are the accepted ones."""
    parsed = parse_submissions(submissions.select("request_id", "fields"))
    good = parsed.filter(F.col("reason").isNull())
    counts = good.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    return users.join(counts, "request_id", "left").select(
        "request_id", "user_id", "is_new", F.coalesce("n", F.lit(0)).alias("n_rows")
    )
