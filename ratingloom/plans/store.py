"""Versioned tables in one folder: items, rating batches, users given out, models and their logs.

Nothing is changed in place but by ``compact``. Ratings grow by one folder ``batch=<n>`` per append
and a batch counts only once its row is in the rating log, a part of the manifest, so a job that dies half-way leaves
nothing visible and can simply be run again. Item tables, answers to requests for users and models
have folders of their own, named by their logs. One writer at a time; any number of readers.

Within a batch, rows lie in hash buckets of their user, and in ``part=train``, ``part=test`` or ``part=reject``, as the content hash
and the checks decide. Both are computed once per row, on arrival; a fit reads only the train files
and an evaluation only the test files. Refused rows stay with the reason they were refused for.

What follows from a batch alone is written once beside it, when it is asked for first: its counts per
item, and the earlier rows it supersedes (``conflicts``). Everyone known is kept in a table of users,
which takes in new batches and answers after every few of them.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.config import SplitConfig
from ratingloom.operators import lookup
from ratingloom.operators.factorize import factors, load_model, save_model
from ratingloom.operators.sampling import split_part
from ratingloom.plans import conflicts
from ratingloom.plans.manifest import Manifest
from ratingloom.sources.buckets import bucket_bytes, bucketed_table, gather, write_bucketed
from ratingloom.sources.staging import read_staged, stage

#: Buckets by user of ratings and user factors; a store keeps its number for good.
USER_BUCKETS = 8
#: The ratings are read by buckets, one task each, if none holds more bytes than this.
BUCKET_BYTES = 512 << 20
#: So many users, or fewer, are looked up by their ids; the ratings of more are found by a join.
FEW_USERS = 100
#: Answers, or batches of ratings, that may wait before the table of users takes them in.
WAITING = 16

STORED_RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("rated_at", T.TimestampType()),
    T.StructField("line", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("part", T.StringType()),
])

SETTINGS = T.StructType([
    T.StructField("seed", T.LongType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("train_buckets", T.IntegerType()),
    T.StructField("user_buckets", T.IntegerType()),
])

RATING_LOG = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("n_rejected", T.LongType()),
    T.StructField("max_user_id", T.LongType()),
    T.StructField("fingerprint", T.LongType()),
    T.StructField("largest_bucket", T.LongType()),
])

COUNT_LOG = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("folder", T.StringType()),
])

USER_FACTORS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("user_factor", T.ArrayType(T.FloatType())),
])

USER_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("n_new", T.LongType()),
    T.StructField("max_user_id", T.LongType()),
])

REGISTRY_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("folder", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("answer", T.StringType()),
])

REGISTERED = T.StructType([T.StructField("user_id", T.LongType())])

ITEM_LOG = T.StructType([
    T.StructField("items_version", T.LongType()),
    T.StructField("n_items", T.LongType()),
])

MODEL_LOG = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch", T.LongType()),
    T.StructField("items_version", T.LongType()),
    T.StructField("n_ratings", T.LongType()),
    T.StructField("max_user_id", T.LongType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("n_rejected", T.LongType()),
    T.StructField("n_scored", T.LongType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("on_conflict", T.StringType()),
    T.StructField("solver", T.StringType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("seed", T.LongType()),
    T.StructField("user_blocks", T.IntegerType()),
    T.StructField("item_blocks", T.IntegerType()),
    T.StructField("split_seed", T.LongType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("train_buckets", T.IntegerType()),
])

ALLOCATED = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("is_new", T.BooleanType()),
])


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.manifest = Manifest(spark, self.path)
        settings = self._log("settings", SETTINGS).first().asDict()
        self.user_buckets = settings.pop("user_buckets")
        self.split = SplitConfig(**settings)

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, split: SplitConfig = SplitConfig(), user_buckets: int = USER_BUCKETS
    ) -> "Store":
        """Open a store; a new one gets a first manifest and keeps its settings for good. Choose
        ``user_buckets`` once, for the largest size expected."""
        setting = (split.seed, split.buckets, split.train_buckets, user_buckets)
        manifest = Manifest(spark, path)
        if not manifest.versions():
            manifest.add("settings", SETTINGS, setting)
        return cls(spark, path)

    # Items

    def put_items(self, items: DataFrame) -> int:
        """Write a new version of the item table; older versions stay as they are."""
        version = (self.items_version() or 0) + 1
        table = stage(items, f"{self.path}/items/version={version}", cluster_by=["item_id"])
        self._add("item_log", ITEM_LOG, (version, table.count()))
        return version

    def items_version(self) -> int | None:
        return self._log("item_log", ITEM_LOG).agg(F.max("items_version")).first()[0]

    def items(self, version: int | None = None) -> DataFrame:
        version = self.items_version() if version is None else version
        return read_staged(self.spark, f"{self.path}/items/version={version}")

    # Ratings

    def append(self, ratings: DataFrame, source: str) -> int:
        """Write a batch and return its number. Rows with a ``reason`` are kept as rejects.

        A source already in the log is not written again, so replaying an append is harmless; other
        rows under the same source are an error. Files are clustered by user for look-ups. The
        input is computed once; what the log tells about the batch is counted by the writing tasks.
        """
        given = dict(ratings.dtypes)
        rows = ratings.select(
            "user_id", "item_id", F.col("rating").cast("double").alias("rating"), *[
                (F.col(c) if c in given else F.lit(None)).cast(kind).alias(c)
                for c, kind in (("rated_at", "timestamp"), ("line", "string"), ("reason", "string"))
            ],
        )
        content = F.bit_xor(F.xxhash64(*rows.columns)).alias("fingerprint")
        done = self.rating_log().filter(F.col("source") == source).first()
        if done is not None:
            seen = rows.agg(content, F.count(F.lit(1)).alias("n")).first()
            n = done.n_train + done.n_test + done.n_rejected
            if (seen.fingerprint, seen.n) != (done.fingerprint, n):
                raise ValueError(f"source {source!r} is batch {done.batch}, which has other rows")
            return done.batch
        batch = self.latest_batch() + 1
        part = F.when(F.col("reason").isNotNull(), "reject").otherwise(split_part(self.split))
        good = F.col("part") != "reject"
        written = Observation()
        observed = gather(rows.withColumn("part", part), "user_id", self.user_buckets).observe(
            written,
            F.count_if(F.col("part") == "train").alias("n_train"),
            F.count_if(F.col("part") == "test").alias("n_test"),
            F.count_if(~good).alias("n_rejected"),
            F.max(F.when(good, F.col("user_id"))).alias("max_user_id"),
            content,
        )
        path = f"{self.path}/ratings/batch={batch}"
        write_bucketed(observed, path, "user_id", self.user_buckets, ("part",))
        self._add("rating_log", RATING_LOG, (batch, source, *[
            written.get[c]
            for c in ("n_train", "n_test", "n_rejected", "max_user_id", "fingerprint")
        ], bucket_bytes(self.spark, path)))
        return batch

    def latest_batch(self) -> int:
        return self.rating_log().agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]

    def _stored(self, upto: int, by_user: bool = False) -> DataFrame:
        if upto == 0:
            return self.spark.createDataFrame([], STORED_RATINGS)
        if not by_user:
            table = self.spark.read.schema(STORED_RATINGS).parquet(f"{self.path}/ratings")
            return table.filter(F.col("batch") <= upto)
        batches = self.rating_log().filter(F.col("batch") <= upto).collect()
        there = [(r.batch, p) for r in batches for p, n in (("train", r.n_train), ("test", r.n_test), ("reject", r.n_rejected)) if n]
        table = bucketed_table(
            self.spark, f"{self.path}/ratings", STORED_RATINGS, "user_id", self.user_buckets, ("batch", "part"), there)
        return table.filter(F.col("batch") <= upto)

    def stored(self, upto: int, part: str | None = None, by_user: bool = False) -> DataFrame:
        """Accepted rows as they came, with ``batch`` and ``part``, of one part or both."""
        wanted = F.col("part").isin("train", "test") if part is None else F.col("part") == part
        return self._stored(upto, by_user).filter(wanted).drop("line", "reason")

    def rows_of_batch(self, batch: int) -> DataFrame:
        return self.stored(batch).filter(F.col("batch") == batch)

    def ratings(
        self, upto: int | None = None, part: str | None = None, on_conflict: str = "keep", by_user: bool = False
    ) -> DataFrame:
        """Ratings as of a batch, of one part or both. Batch and part prune whole folders.

        ``latest`` keeps one row per user and item: of the last batch, then by time, then rating.
        What each batch supersedes is written down when it is asked for first; a read then leaves
        out those rows. ``by_user`` reads the rows by buckets of the user, for joins with
        ``user_factors`` without a shuffle, unless a bucket is too large for one task.
        """
        upto = self.latest_batch() if upto is None else upto
        if on_conflict == "latest":
            return conflicts.current(self, upto, conflicts.settle(self, upto), part).drop("batch")
        return self.stored(upto, part, by_user and self.even_buckets(upto)).drop("batch", "part")

    def ratings_of(self, users: DataFrame, upto: int | None = None, on_conflict: str = "keep") -> DataFrame:
        """Ratings of the users in a table; asking for a user twice changes nothing.

        The ids of a few go to the files as they are: of the buckets only theirs are opened, and in
        these, page bounds, dictionaries and Bloom filters leave out what holds none of them. More
        users meet the ratings in their buckets, for which the ratings aren't moved.
        """
        asked = users.select("user_id").filter("user_id is not null").distinct()
        few = [r.user_id for r in asked.limit(FEW_USERS + 1).collect()]
        if len(few) <= FEW_USERS:
            upto = self.latest_batch() if upto is None else upto
            wanted = F.col("user_id").isin(few)
            # nothing here needs whole buckets, so a large one is read in several splits
            if on_conflict == "keep":
                return self.stored(upto, by_user=True).filter(wanted).drop("batch", "part")
            return self.ratings(upto, on_conflict=on_conflict).filter(wanted)
        return lookup.user_ratings(self.ratings(upto, on_conflict=on_conflict, by_user=True), asked)

    def even_buckets(self, upto: int) -> bool:
        """Whether no user bucket, as of a batch, has more bytes than one task should read."""
        most = self.rating_log().filter(F.col("batch") <= upto).agg(F.sum("largest_bucket")).first()[0]
        return most is not None and most <= BUCKET_BYTES

    def item_counts(self, upto: int | None = None, on_conflict: str = "keep") -> DataFrame:
        """``item_id, n``: ratings per item as of a batch. Each batch is counted once and its counts
        are written; the sum over batches reads nothing else."""
        upto = self.latest_batch() if upto is None else upto
        if on_conflict == "latest":
            return conflicts.rated_pairs(self, conflicts.settle(self, upto))
        log = self._log("count_log", COUNT_LOG).groupBy("batch").agg(F.min("folder").alias("folder"))
        done = {r.batch: r.folder for r in log.collect()}
        for batch in range(1, upto + 1):
            if batch not in done:
                done[batch] = f"counts/batch={batch}-{uuid.uuid4().hex}"
                counts = self.rows_of_batch(batch).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
                counts.write.parquet(f"{self.path}/{done[batch]}")
                self._add("count_log", COUNT_LOG, (batch, done[batch]))
        folders = [f"{self.path}/{done[b]}" for b in range(1, upto + 1)]
        if not folders:
            return self.spark.createDataFrame([], conflicts.CHANGES)
        counts = self.spark.read.schema(conflicts.CHANGES).parquet(*folders)
        return counts.groupBy("item_id").agg(F.sum("n").alias("n"))

    def rejects(self, upto: int | None = None) -> DataFrame:
        """Refused rows of all batches, as far as they could be read, with their reasons."""
        table = self._stored(self.latest_batch() if upto is None else upto)
        return table.filter(F.col("part") == "reject").drop("part")

    def totals(self, upto: int, on_conflict: str = "keep") -> dict:
        """``n_ratings, n_train, n_test, n_rejected, max_user_id`` as of a batch: from the log, or,
        where pairs are reduced to their latest row, counted."""
        batches = self.rating_log().filter(F.col("batch") <= upto)
        names = ("n_train", "n_test", "n_rejected")
        totals = batches.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
            F.coalesce(F.max("max_user_id"), F.lit(0)).alias("max_user_id"),
        ).first().asDict()
        if on_conflict == "latest":
            for part in ("train", "test"):
                totals[f"n_{part}"] = self.ratings(upto, part, on_conflict).count()
        return totals | {"n_ratings": totals["n_train"] + totals["n_test"]}

    def rating_log(self) -> DataFrame:
        return self._log("rating_log", RATING_LOG)

    def compact(self, upto: int | None = None) -> str:
        """Rewrite the store as of a batch into a new folder with one file set per part and log.

        Readers of the old folder are not disturbed; the caller moves on to the new one, whose
        path is returned. Batches keep their numbers, so models keep what they were fitted on.
        """
        upto = self.latest_batch() if upto is None else upto
        path = f"{self.path}-compact-{uuid.uuid4().hex}"
        target = Store.create(self.spark, path, self.split, self.user_buckets)
        rows = gather(self._stored(upto), "user_id", self.user_buckets)
        write_bucketed(rows, f"{path}/ratings", "user_id", self.user_buckets, ("batch", "part"))
        moved = F.col("log").isin("rating_log", "user_log", "item_log", "model_log")
        target.manifest.extend(self.manifest.entries().filter(moved))
        for row in self._log("item_log", ITEM_LOG).collect():
            stage(self.items(row.items_version), f"{path}/items/version={row.items_version}", ["item_id"])
        for row in self.user_log().collect():
            self._answer(row.folder).coalesce(1).write.parquet(f"{path}/users/{row.folder}")
        for row in self.model_log().collect():
            target.put_model(self.model(row.version), row.version)
        return target.path

    # Users: answers to requests, kept under their source.

    def user_log(self) -> DataFrame:
        return self._log("user_log", USER_LOG)

    def _answer(self, folder: str) -> DataFrame:
        return self.spark.read.schema(ALLOCATED).parquet(f"{self.path}/users/{folder}")

    def answered(self, source: str) -> DataFrame | None:
        row = self.user_log().filter(F.col("source") == source).first()
        return None if row is None else self._answer(row.folder)

    def put_users(self, allocated: DataFrame, source: str) -> DataFrame:
        """Write an answer down; ids in it are taken from then on."""
        folder = f"answer={uuid.uuid4().hex}"
        seen = Observation()
        allocated.select(*ALLOCATED.names).observe(
            seen, F.count_if("is_new").alias("n_new"), F.max("user_id").alias("max_user_id")
        ).write.parquet(f"{self.path}/users/{folder}")
        self._add("user_log", USER_LOG, (source, folder, seen.get["n_new"], seen.get["max_user_id"]))
        if max(len(self.waiting_answers()), self.latest_batch() - self._registry()[0]) > WAITING:
            self.merge_users()
        return self._answer(folder)

    def users(self) -> DataFrame:
        """``user_id`` of everyone with a rating, as of now, and of everyone created: the table of
        users and what came since, of which only the new batches and answers are read. Ids may repeat."""
        batch, folder = self._registry()
        found = self.stored(self.latest_batch()).filter(F.col("batch") > batch).select("user_id")
        if folder is not None:
            found = found.unionByName(self.registered(folder))
        paths = [f"{self.path}/users/{f}" for f in self.waiting_answers()]
        if not paths:
            return found
        created = self.spark.read.schema(ALLOCATED).parquet(*paths).filter("is_new")
        return found.unionByName(created.select("user_id"))

    def registered(self, folder: str) -> DataFrame:
        """A table of users, each once, in the buckets of the ratings."""
        return bucketed_table(self.spark, f"{self.path}/{folder}", REGISTERED, "user_id", self.user_buckets)

    def merge_users(self) -> str:
        """Write the table of users anew with all that came since, and log what it holds. Until it is
        logged, readers see the earlier one; a merge that dies leaves nothing visible."""
        batch, answers = self.latest_batch(), self.waiting_answers()
        version = self._log("registry_log", REGISTRY_LOG).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        folder = f"registry/version={version}-{uuid.uuid4().hex}"
        everyone = self.users().filter("user_id is not null").distinct()
        write_bucketed(gather(everyone, "user_id", self.user_buckets), f"{self.path}/{folder}", "user_id", self.user_buckets)
        self._add("registry_log", REGISTRY_LOG, *[(version, folder, batch, answer) for answer in [None, *answers]])
        return folder

    def _registry(self) -> tuple[int, str | None]:
        """The last batch that the table of users holds, and its folder."""
        newest = self._log("registry_log", REGISTRY_LOG).agg(F.max(F.struct("version", "batch", "folder")).alias("r")).first().r
        return (0, None) if newest is None else (newest.batch, newest.folder)

    def waiting_answers(self) -> list[str]:
        """Folders of answers with new users that the table of users doesn't hold; a few at most."""
        taken = self._log("registry_log", REGISTRY_LOG).filter("answer is not null").select(F.col("answer").alias("folder"))
        return [r.folder for r in self.user_log().filter("n_new > 0").join(taken, "folder", "left_anti").collect()]

    def largest_user_id(self) -> int:
        """The largest id that has ratings or was given out, from the logs."""
        logs = self.rating_log().select("max_user_id").unionByName(self.user_log().select("max_user_id"))
        return logs.agg(F.coalesce(F.max("max_user_id"), F.lit(0))).first()[0]

    # Models

    def put_model(self, model: ALSModel, version: int) -> ALSModel:
        """Save and read back: scoring then reads files instead of the fit's lineage."""
        path = f"{self.path}/models/version={version}"
        save_model(model, path)
        saved = load_model(path)
        rows = gather(factors(saved, "user"), "user_id", self.user_buckets)
        write_bucketed(rows, f"{self.path}/user_factors/version={version}", "user_id", self.user_buckets)
        return saved

    def user_factors(self, version: int) -> DataFrame:
        """``user_id, user_factor`` of a model, in the buckets of the ratings."""
        return bucketed_table(self.spark, f"{self.path}/user_factors/version={version}", USER_FACTORS, "user_id", self.user_buckets)

    def commit_model(self, metrics: dict) -> DataFrame:
        """Make a saved model the current one by logging it with its metrics and settings."""
        split = asdict(self.split)
        metrics = {**split, "split_seed": split["seed"], **metrics}
        row = tuple(metrics.get(field.name) for field in MODEL_LOG)
        self._add("model_log", MODEL_LOG, row)
        return self.spark.createDataFrame([row], MODEL_LOG)

    def latest_version(self) -> int | None:
        return self.model_log().agg(F.max("version")).first()[0]

    def model(self, version: int | None = None) -> ALSModel:
        version = self.latest_version() if version is None else version
        if version is None:
            raise LookupError("no model has been trained in this store")
        return load_model(f"{self.path}/models/version={version}")

    def model_log(self) -> DataFrame:
        return self._log("model_log", MODEL_LOG)

    # Logs hold one row per batch, answer or version; all of them are in one manifest.

    def _add(self, name: str, schema: T.StructType, *added: tuple) -> None:
        self.manifest.add(name, schema, *added)

    def _log(self, name: str, schema: T.StructType) -> DataFrame:
        return self.manifest.log(name, schema)
