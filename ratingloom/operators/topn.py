"""Ranked recommendations."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.blocks import best_outside
from ratingloom.operators.factorize import fits_id_range


def recommend(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """``user_id, rank, item_id, score``: the n best items of the given users, or of all.

    Users without training ratings get no rows; asking for a user twice gives one list.
    Items the user rated already are not left out, see ``recommend_unseen``.

    The same pass over pairs of factor blocks as ``recommend_unseen``, with nothing left out: only n
    rows per user leave it. Equal scores go by item id.
    """
    if users is not None:
        users = users.filter(fits_id_range("user_id")).select(F.col("user_id").cast("bigint"))
    nothing = model.userFactors.sparkSession.createDataFrame([], "user_id bigint, item_id bigint")
    return best_outside(model, n, nothing, users)


def with_titles(recommendations: DataFrame, items: DataFrame) -> DataFrame:
    """Add the title; an item missing from the catalogue drops out and leaves a rank unused."""
    titles = items.select("item_id", "title")
    return recommendations.join(titles, "item_id").select(
        "user_id", "rank", "item_id", "title", "score"
    )


def recommend_unseen(
    model: ALSModel, n: int, ratings: DataFrame, users: DataFrame | None = None
) -> DataFrame:
    """Like ``recommend``, without the items the user rated already. Exact for every user.

    One pass over the pairs of factor blocks, as for the plain lists; what a user has seen is masked
    in the block's scores before its best are taken, however much it is.
    """
    return best_outside(model, n, ratings, users)
