"""Good rows and refused rows of a parsed frame, told apart by its ``reason`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.config import ID_MAX, ID_MIN


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull())


def is_finite(number: Column) -> Column:
    """False for null, NaN and the infinities."""
    return F.coalesce(F.abs(number) < F.lit(float("inf")), F.lit(False))


def user_reason() -> Column:
    return F.when(F.col("user_id").isNull(), "no_user").when(
        ~F.col("user_id").between(ID_MIN, ID_MAX), "user_out_of_range"
    )


def parsed_reason(
    reason: Column, min_rating: float | None = None, max_rating: float | None = None
) -> Column:
    """Continue a reason with those of an item and a rating parsed from text. Each column is
    named as rarely as can be: a filter on the reason parses again for each mention."""
    reason = reason.when(F.col("item_id").isNull(), "bad_item")
    reason = reason.when(~is_finite(F.col("rating")), "bad_rating")
    if min_rating is not None:
        reason = reason.when(F.col("rating") < min_rating, "rating_out_of_range")
    if max_rating is not None:
        reason = reason.when(F.col("rating") > max_rating, "rating_out_of_range")
    return reason


def rating_reason(min_rating: float | None = None, max_rating: float | None = None) -> Column:
    """Why a ``user_id, item_id, rating`` row cannot be used, or null if it can."""
    reason = user_reason().when(
        ~F.col("item_id").between(ID_MIN, ID_MAX), "item_out_of_range"
    )
    return parsed_reason(reason, min_rating, max_rating)


def check_ratings(
    ratings: DataFrame, min_rating: float | None = None, max_rating: float | None = None
) -> DataFrame:
    """Add ``reason``. Ratings are not clamped; a range is checked only where one is given."""
    return ratings.withColumn("reason", rating_reason(min_rating, max_rating))


def check_items(items: DataFrame) -> DataFrame:
    """Add ``reason`` to an item table read from CSV."""
    return items.withColumn("reason", F.when(F.col("item_id").isNull(), "bad_item"))
