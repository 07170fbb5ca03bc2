"""Properties a right result must have, computed as tables."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import dot
from ratingloom.operators.blocks import best_outside
from ratingloom.operators.factorize import factors


def optimality(
    model: ALSModel, train: DataFrame, reg_param: float, tolerance: float = 1e-4
) -> DataFrame:
    """``user_id, ok`` for every user with training ratings.

    User factors are solved last, so each must zero the gradient of the regularised squared
    error over its user's n ratings: sum of v (v.u - r), plus reg_param n u. ``ok`` means no
    component of the gradient, divided by n, exceeds the tolerance.
    """
    # Items are joined first; then each user's rows are brought together once and summed where
    # they arrive. Sums taken per task before they move would be one row per user and task, so
    # they would grow with the tasks and not only with the ratings.
    rows = train.join(factors(model, "item"), "item_id").repartition("user_id")
    rows = rows.join(factors(model, "user"), "user_id")
    error = dot(F.col("user_factor"), F.col("item_factor"), model.rank) - F.col("rating")
    components = range(model.rank)
    sums = rows.withColumn("_error", error).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(F.get("user_factor", F.lit(k))).alias(f"u{k}") for k in components],
        *[
            F.sum(F.col("_error") * F.get("item_factor", F.lit(k))).alias(f"g{k}")
            for k in components
        ],
    )
    slopes = [
        F.abs(F.col(f"g{k}") / F.col("n") + reg_param * F.col(f"u{k}")) for k in components
    ]
    steepest = F.array_max(F.array(*slopes))
    return sums.select("user_id", (steepest <= tolerance).alias("ok"))


def list_shape(recommendations: DataFrame) -> DataFrame:
    """``user_id, n_rows, ranks_ok, scores_ok, distinct_ok`` per recommendation list: ranks are
    1 to n, scores never rise with rank, and no item comes twice."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", "score", "item_id")))
    lists = recommendations.groupBy("user_id").agg(pairs.alias("entries"))
    ranks, scores = F.col("entries.rank"), F.col("entries.score")
    return lists.select(
        "user_id",
        F.size("entries").cast("bigint").alias("n_rows"),
        (ranks == F.sequence(F.lit(1), F.size("entries"))).alias("ranks_ok"),
        (scores == F.reverse(F.array_sort(scores))).alias("scores_ok"),
        (F.size(F.array_distinct("entries.item_id")) == F.size("entries")).alias("distinct_ok"),
    )


def nothing_better(
    model: ALSModel, lists: DataFrame, n: int, seen: DataFrame | None = None, tolerance: float = 1e-4
) -> DataFrame:
    """``user_id, n_rows, best_ok`` of each listed user: the scores are the factors' own products,
    and no item outside the list, nor among the user's ``seen`` ones, scores above the last of it.
    A list shorter than n must hold all items but the seen ones, and no list holds a seen one.

    The best item outside the list comes from the blocked product over all pairs, with listed and
    seen pairs left out.
    """
    scored = lists.join(factors(model, "user"), "user_id", "left").join(factors(model, "item"), "item_id", "left")
    exact = dot(F.col("user_factor"), F.col("item_factor"), model.rank)
    right = F.coalesce(F.abs(F.col("score") - exact) <= tolerance, F.lit(False))
    left_out = lists.select("user_id", "item_id")
    if seen is None:
        scored = scored.withColumn("listed_seen", F.lit(False))
    else:
        pairs = seen.select("user_id", "item_id").distinct()
        scored = scored.join(pairs.withColumn("listed_seen", F.lit(True)), ["user_id", "item_id"], "left")
        left_out = left_out.unionByName(pairs)
    checked = scored.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("score").alias("last"),
        F.bool_and(right & ~F.coalesce("listed_seen", F.lit(False))).alias("rows_ok"),
    )
    rest = best_outside(model, 1, left_out, lists.select("user_id").distinct()).select("user_id", F.col("score").alias("next"))
    no_better = F.col("next").isNull() | (F.col("next") <= F.col("last") + tolerance)
    full = (F.col("n_rows") == n) | F.col("next").isNull()
    return checked.join(rest, "user_id", "left").select("user_id", "n_rows", (F.col("rows_ok") & full & no_better).alias("best_ok"))
