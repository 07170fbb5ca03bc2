"""Training from scratch, and again after new ratings."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame

from ratingloom.config import AlsConfig
from ratingloom.operators.evaluate import rmse
from ratingloom.operators.factorize import fit
from ratingloom.operators.predict import predict
from ratingloom.plans.store import Store
from ratingloom.sources.rejects import accepted, check_items, check_ratings


def train_pipeline(
    store: Store, items: DataFrame, ratings: DataFrame, als: AlsConfig = AlsConfig(),
    source: str = "initial",
) -> DataFrame:
    """Stage both tables, fit and evaluate. Returns the model's log row.

    The ratings are computed once, on arrival. Later steps scan the parquet columns they need,
    which is cheaper than caching tables of this size and survives the loss of executors. Training
    a store again with the same ratings only fits again; with others under the same source it is
    an error, so that no rows are passed over unseen.
    """
    store.append(check_ratings(ratings), source)
    store.put_items(accepted(check_items(items)))
    return refit(store, als)


def refit(store: Store, als: AlsConfig = AlsConfig(), on_conflict: str = "keep") -> DataFrame:
    """Fit and evaluate on everything appended so far, as a model version of its own."""
    batch = store.latest_batch()
    version = (store.latest_version() or 0) + 1
    totals = store.totals(batch, on_conflict)
    train = store.ratings(batch, "train", on_conflict)
    test = store.ratings(batch, "test", on_conflict, by_user=True)
    model = store.put_model(fit(train, als, n_rows=totals["n_train"]), version)
    score = rmse(predict(model, test, store.user_factors(version))).first()
    return store.commit_model({
        **totals,
        **asdict(als),
        "version": version,
        "batch": batch,
        "items_version": store.items_version(),
        "n_scored": score.n,
        "rmse": score.rmse,
        "on_conflict": on_conflict,
    })


def add_ratings(
    store: Store, new: DataFrame, source: str, als: AlsConfig = AlsConfig(),
    min_rating: float | None = None, max_rating: float | None = None, on_conflict: str = "keep",
) -> DataFrame:
    """Append a batch of ``user_id, item_id, rating`` rows and refit. Returns the log row.

    Rows that cannot be used are kept as the batch's rejects. Rows that were parsed from text come
    with their own ``reason``, which stays.
    """
    checked = new if "reason" in new.columns else check_ratings(new, min_rating, max_rating)
    store.append(checked, source)
    return refit(store, als, on_conflict)
