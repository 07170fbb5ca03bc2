"""Row look-ups and checks of incoming requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import strip, to_id


def item_by_id(items: DataFrame, item_id: int) -> DataFrame:
    """The plain bigint comparison reaches the parquet scan."""
    return items.filter(F.col("item_id") == F.lit(item_id).cast("bigint"))


def item_lookup(items: DataFrame, requested: DataFrame) -> DataFrame:
    """``item_id, title, genres, status`` for every requested ``item_id``."""
    found = items.select("item_id", "title", "genres", F.lit(True).alias("_found"))
    status = F.when(F.col("_found"), "ok").otherwise("not_found")
    return requested.select("item_id").join(found, "item_id", "left").select(
        "item_id", "title", "genres", status.alias("status")
    )


def ratings_of_user(ratings: DataFrame, user_id: int) -> DataFrame:
    return ratings.filter(F.col("user_id") == F.lit(user_id).cast("bigint"))


def user_ratings(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """All ratings of the requested users; asking for a user twice changes nothing."""
    wanted = users.select("user_id")
    return ratings.join(wanted, "user_id", "left_semi")


def validate_requests(
    requests: DataFrame, numeric: list[str], positive: list[str] = (), optional: list[str] = ()
) -> DataFrame:
    """Check text parameters. Columns of ``numeric`` must hold a whole number, those of
    ``positive`` one above zero, and those of ``optional`` a whole number or nothing. They become
    bigint, and ``reason`` names the first that fails."""
    bad: list[Column] = []
    for name in [*numeric, *positive, *optional]:
        value = to_id(F.col(name))
        wrong = value.isNull()
        if name in positive:
            wrong = wrong | (value <= 0)
        if name in optional:
            wrong = wrong & (F.length(strip(F.col(name))) > 0)
        bad.append(F.when(wrong, f"bad_{name}"))
    checked = requests.withColumn("reason", F.coalesce(*bad))
    return checked.withColumns({c: to_id(F.col(c)) for c in [*numeric, *positive, *optional]})
