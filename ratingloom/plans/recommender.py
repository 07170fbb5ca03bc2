"""Everything a client of the recommender asks for, as operations on whole tables of requests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.config import POPULAR_LIMIT, SAMPLE_SEED, AlsConfig, SplitConfig
from ratingloom.operators import lookup, predict, profile, registry, sampling, topn
from ratingloom.plans import pipeline, submissions
from ratingloom.plans.store import Store
from ratingloom.sources import csv_tables, uploads


class Recommender:
    """A read-only view of one version of a store. Methods that add ratings return a new view."""

    def __init__(self, store: Store, version: int | None = None, als: AlsConfig = AlsConfig()):
        self.store, self.als = store, als
        self.version = store.latest_version() if version is None else version
        self.model = store.model(self.version)
        row = self.log().first()
        self.items = store.items(row.items_version)
        self.ratings = store.ratings(row.batch, on_conflict=row.on_conflict)

    @classmethod
    def train(
        cls, spark: SparkSession, path: str, items_csv: str, ratings_csv: str,
        als: AlsConfig = AlsConfig(), split: SplitConfig = SplitConfig(),
    ) -> "Recommender":
        """Load two CSV files into a new store and train on them."""
        store = Store.create(spark, path, split)
        pipeline.train_pipeline(
            store,
            csv_tables.read_items(spark, items_csv),
            csv_tables.read_ratings(spark, ratings_csv, keep_time=True),
            als,
        )
        return cls(store, als=als)

    def log(self) -> DataFrame:
        """Sizes, settings and hold-out error of this version."""
        return self.store.model_log().filter(F.col("version") == self.version)

    # Users. Who exists and which ids are taken is asked of the store as it is now, whatever
    # version this view shows.

    def known_users(self, requests: DataFrame, mode: str = "exists") -> DataFrame:
        store = self.store
        return registry.known_users(requests, store.users(), mode, store.largest_user_id())

    def create_users(
        self, requests: DataFrame, mode: str = "exists", source: str | None = None
    ) -> DataFrame:
        """Ids for requests. They are taken from then on; the same source gets the same answer."""
        source = source or f"requests:{uuid.uuid4().hex}"
        answer = self.store.answered(source)
        if answer is not None:
            return answer
        repeats = registry.repeated_requests(requests)
        if not repeats.isEmpty():
            raise ValueError(f"request_id {repeats.first().request_id} is used more than once")
        store = self.store
        allocated = registry.allocate_users(requests, store.users(), mode, store.largest_user_id())
        return store.put_users(allocated, source)

    # Items

    def popular(self, k: int = POPULAR_LIMIT) -> DataFrame:
        """The most rated items, from the counts of each batch: after an append only the new one is
        counted."""
        row = self.log().first()
        counts = self.store.item_counts(row.batch, row.on_conflict)
        return profile.most_rated(profile.counted_items(self.items, counts), k)

    def sample_items(
        self, n: int = 1, seed: int = SAMPLE_SEED, pool: str = "popular"
    ) -> DataFrame:
        """Items to rate, from the most rated ones or from ``pool='all'``."""
        return sampling.sample_items(self.popular() if pool == "popular" else self.items, n, seed)

    def find_items(self, requested: DataFrame) -> DataFrame:
        return lookup.item_lookup(self.items, requested)

    # Ratings

    def ratings_for(self, users: DataFrame) -> DataFrame:
        row = self.log().first()
        found = self.store.ratings_of(users, row.batch, row.on_conflict)
        return found.select("user_id", "item_id", "rating")

    def add_ratings(self, new: DataFrame, source: str, **options) -> "Recommender":
        """``options``: ``min_rating``, ``max_rating``, ``on_conflict``."""
        pipeline.add_ratings(self.store, new, source, self.als, **options)
        return Recommender(self.store, als=self.als)

    def upload(
        self, path: str, source: str, min_rating: float | None = None,
        max_rating: float | None = None, on_conflict: str = "keep",
    ) -> "Recommender":
        """Add the rating files under ``path/user_id=<id>/``."""
        lines = uploads.read_uploads(self.store.spark, path)
        parsed = uploads.parse_lines(lines, min_rating, max_rating)
        return self.add_ratings(parsed, source, on_conflict=on_conflict)

    def submit(
        self, forms: DataFrame, source: str, mode: str = "exists", on_conflict: str = "keep"
    ) -> tuple["Recommender", DataFrame]:
        """Add the ratings of a batch of forms; also returns who was created.

        The allocated ids are written down first, under the source, so that the ratings and the
        answer agree whatever is recomputed or replayed.
        """
        users = self.create_users(forms.select("request_id", "user_id"), mode, f"forms:{source}")
        rows = submissions.submitted_ratings(forms, users).drop("request_id")
        summary = submissions.submission_summary(forms, users)
        return self.add_ratings(rows, source, on_conflict=on_conflict), summary

    # Predictions

    def predict(self, pairs: DataFrame) -> DataFrame:
        return predict.predict(self.model, pairs)

    def report(self, pairs: DataFrame) -> DataFrame:
        return predict.prediction_report(self.predict(pairs), self.items)

    def recommend(
        self, n: int, users: DataFrame | None = None, exclude_seen: bool = False
    ) -> DataFrame:
        if exclude_seen:
            lists = topn.recommend_unseen(self.model, n, self.ratings, users)
        else:
            lists = topn.recommend(self.model, n, users)
        return topn.with_titles(lists, self.items)
