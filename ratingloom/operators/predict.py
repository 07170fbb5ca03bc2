"""Ratings predicted for any number of (user, item) pairs."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import dot
from ratingloom.operators.factorize import factors


#: Item factors of up to this many numbers are sent to all tasks where users come by buckets.
SENT_NUMBERS = 16_000_000


def predict(model: ALSModel, pairs: DataFrame, user_factors: DataFrame | None = None) -> DataFrame:
    """Every pair with ``prediction`` and ``status``; no pair is lost.

    The prediction is null where the user or the item was not in training, and the status says
    which. Two left joins answer both, where MLlib's transform would need two more to tell
    unknown users from unknown items. Hot users and items sit on the left side of the joins,
    which adaptive execution can split.

    ``user_factors`` are the model's from ``Store.user_factors``: pairs read from the store by user
    buckets then meet them where they lie, and no pair moves unless the items are too many to send.
    """
    items = factors(model, "item")
    if user_factors is not None and model.itemFactors.count() * model.rank <= SENT_NUMBERS:
        items = F.broadcast(items)
    score = dot(F.col("user_factor"), F.col("item_factor"), model.rank)
    has_user, has_item = F.col("user_factor").isNotNull(), F.col("item_factor").isNotNull()
    status = (
        F.when(has_user & has_item, "ok")
        .when(has_item, "unknown_user")
        .when(has_user, "unknown_item")
        .otherwise("unknown_both")
    )
    return (
        pairs.join(factors(model, "user") if user_factors is None else user_factors, "user_id", "left")
        .join(items, "item_id", "left")
        .select(
            *pairs.columns,
            score.cast("float").alias("prediction"),
            status.alias("status"),
        )
    )


def prediction_report(
    predictions: DataFrame, items: DataFrame, keep_exact: bool = False
) -> DataFrame:
    """Predictions for reading: the item's title, and the value rounded to two decimals.

    ``keep_exact`` keeps the unrounded ``prediction`` beside it, for checks in the same pass."""
    titles = items.select("item_id", "title")
    exact = ["prediction"] if keep_exact else []
    return predictions.join(titles, "item_id", "left").select(
        "user_id", "item_id", "title",
        F.round(F.col("prediction").cast("double"), 2).alias("predicted_rating"), "status",
        *exact,
    )
