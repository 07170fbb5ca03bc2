"""One Spark query per operator, over the whole driver tables.

Requests, uploads and forms are derived from table columns row by row, so they grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.config import PRESET_A, PRESET_B, AlsConfig
from ratingloom.operators import (
    append, evaluate, factorize, lookup, predict, profile, registry, sampling, topn,
)
from ratingloom.plans import checks, pipeline, submissions
from ratingloom.plans.recommender import Recommender
from ratingloom.plans.store import Store
from ratingloom.sources import (
    accepted, csv_tables, exports, forms, rejected, stage, uploads,
)
from ratingloom.sources.star_tables import items, ratings, table, timed_ratings
from ratingloom.streaming.uploads import ingest_uploads
from ratingloom.workspace import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOP_N = 10
# Dates that cut the ratings into a base and a batch. Early: many users and items come later.
LATE_CUT = "2000-01-01"
EARLY_CUT = "1995-06-01"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text(column: str):
    return F.col(column).cast("string")


# Derived inputs


def base_and_batch(spark: SparkSession, folder: str, cut: str) -> tuple[DataFrame, DataFrame]:
    rows = timed_ratings(spark, folder)
    before = F.col("rated_at") < F.lit(cut).cast("timestamp_ntz")
    return rows.filter(before), rows.filter(~before)


def user_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per customer: no id for one market segment, else the whole part of the
    account balance, which gives negative, known and unknown ids."""
    wanted = F.when(F.col("c_mktsegment") != "BUILDING", F.floor("c_acctbal").cast("bigint"))
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("request_id"), wanted.alias("user_id")
    )


def pair_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One pair per event; users and items are each known in part."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("user_id"),
        F.floor(F.col("value") * 100).cast("bigint").alias("item_id"),
    )


def user_list(spark: SparkSession, folder: str) -> DataFrame:
    """Users of all events, with repeats, and as many ids that are mostly unknown."""
    events = table(spark, folder, "events")
    return events.select("user_id").unionByName(events.select(F.col("event_id").alias("user_id")))


def uploaded_texts(spark: SparkSession, folder: str) -> DataFrame:
    """One upload per line item: padded, bad, blank and half-bad lines."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax",
        "l_returnflag", "l_linestatus",
    )
    owners = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    second = F.when(F.col("l_linestatus") == "F", text("l_linenumber")).otherwise("none")
    content = F.concat(
        F.lit("\n "), text("l_partkey"), F.lit(" , "), text("l_quantity"), F.lit("\r\n"),
        F.col("l_returnflag"), F.lit(","), text("l_tax"), F.lit("\n\n"),
        text("l_suppkey"), F.lit(","), second, F.lit("\n"),
    )
    return lines.join(owners, lines.l_orderkey == owners.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), content.alias("content")
    )


def form_fields(*values):
    """An ordered list of name/value fields."""
    fields = [
        F.struct(F.lit(f"field_{k}").alias("name"), value.cast("string").alias("value"))
        for k, value in enumerate(values)
    ]
    return F.array(*fields)


def line_forms(spark: SparkSession, folder: str) -> DataFrame:
    """One form per line item: a good triple, one with a title that may be blank, one whose item
    is not a number, and two dangling fields."""
    title = F.when(F.col("l_returnflag") == "R", "  ").otherwise(F.col("l_returnflag"))
    fields = form_fields(
        F.lit("first"), F.col("l_partkey"), F.col("l_linenumber"),
        title, F.col("l_suppkey"), F.col("l_quantity"),
        F.lit("third"), F.col("l_linestatus"), F.lit("3"),
        F.lit("dangling"), F.col("l_partkey"),
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("submission_id"), fields.alias("fields")
    )


def customer_forms(spark: SparkSession, folder: str) -> DataFrame:
    """One form per customer, under the user id it asks for."""
    requests = user_requests(spark, folder)
    title = F.when(F.col("c_mktsegment") == "MACHINERY", " ").otherwise(F.col("c_mktsegment"))
    fields = form_fields(
        F.col("c_name"), F.col("c_custkey"), F.lit("4"),
        title, F.col("c_nationkey"), F.lit("2.5"),
        F.col("c_name"), F.col("c_nationkey"), F.when(F.col("c_acctbal") < 0, "?").otherwise("1"),
    )
    filled = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("request_id"), fields.alias("fields")
    )
    return requests.join(filled, "request_id")


# Fitted models, one per data set and setting, kept on disk and shared by the queries below.

_MODELS: dict[tuple, str] = {}


def fitted(spark: SparkSession, folder: str, config: AlsConfig = PRESET_A) -> ALSModel:
    key = (spark.sparkContext.applicationId, folder, config)
    if key not in _MODELS:
        train, _ = sampling.split_ratings(ratings(spark, folder))
        path = fresh_path(spark, "model")
        factorize.save_model(factorize.fit(train, config), path)
        _MODELS[key] = path
    return factorize.load_model(_MODELS[key])


def recommendation_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = topn.recommend(fitted(spark, folder), TOP_N)
    return topn.with_titles(lists, items(spark, folder))


# Sources and sinks


@query
def read_items(spark, folder):
    path = fresh_path(spark, "items-csv")
    csv_tables.write_csv(items(spark, folder), path)
    return csv_tables.read_items(spark, path)


@query
def read_items_quoted(spark, folder):
    title = F.concat(F.lit('"'), "title", F.lit('", the '), "genres", F.lit(' "one"'))
    path = fresh_path(spark, "items-csv")
    csv_tables.write_csv(items(spark, folder).withColumn("title", title), path)
    return csv_tables.read_items(spark, path)


@query
def read_ratings(spark, folder):
    rows = timed_ratings(spark, folder).withColumn("rated_at", F.unix_timestamp("rated_at"))
    path = fresh_path(spark, "ratings-csv")
    csv_tables.write_csv(rows, path)
    return csv_tables.read_ratings(spark, path)


@query
def stage_roundtrip(spark, folder):
    return stage(ratings(spark, folder), fresh_path(spark, "ratings"), cluster_by=["user_id"])


@query
def export_json(spark, folder):
    return items(spark, folder).select(
        "item_id", exports.json_records("item_id", "title", "genres").alias("json")
    )


@query
def export_json_files(spark, folder):
    path = fresh_path(spark, "items-json")
    exports.write_json_records(items(spark, folder), path)
    return spark.read.text(path).select(F.col("value").alias("json"))


@query
def parse_uploads(spark, folder):
    lines = uploads.upload_lines(uploaded_texts(spark, folder))
    return accepted(uploads.parse_lines(lines)).drop("line")


@query
def parse_uploads_rejects(spark, folder):
    lines = uploads.upload_lines(uploaded_texts(spark, folder))
    refused = rejected(uploads.parse_lines(lines, max_rating=45))
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def write_upload_files(spark: SparkSession, folder: str) -> str:
    """Customers' balances as files of ``item,rating`` lines, one folder per nation."""
    path = fresh_path(spark, "uploads")
    table(spark, folder, "customer").select(
        F.concat_ws(",", "c_custkey", "c_acctbal").alias("value"),
        F.col("c_nationkey").alias("user_id"),
    ).write.partitionBy("user_id").text(path)
    return path


@query
def read_upload_files(spark, folder):
    lines = uploads.read_uploads(spark, write_upload_files(spark, folder))
    return accepted(uploads.parse_lines(lines)).drop("line")


@query
def ingest_upload_files(spark, folder):
    store = Store.create(spark, fresh_path(spark, "store"))
    inbox = write_upload_files(spark, folder)
    ingest_uploads(store, inbox, fresh_path(spark, "stream")).awaitTermination()
    return store.ratings().drop("rated_at")


@query
def parse_submissions(spark, folder):
    return accepted(forms.parse_submissions(line_forms(spark, folder)))


# Look-ups and request checks


@query
def validate_requests(spark, folder):
    status = F.col("o_orderstatus")
    user = F.when(status == "O", text("o_custkey")).when(status == "F", "").otherwise(
        F.concat(F.lit("x"), text("o_custkey"))
    )
    count = F.when(F.col("o_orderpriority") == "5-LOW", "0").otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    requests = table(spark, folder, "orders").select(user.alias("user"), count.alias("count"))
    checked = lookup.validate_requests(requests, numeric=["user"], positive=["count"])
    outcome = F.coalesce("reason", F.lit("ok")).alias("status")
    return checked.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


@query
def item_lookup(spark, folder):
    wanted = table(spark, folder, "events").select(F.col("event_id").alias("item_id"))
    return lookup.item_lookup(items(spark, folder), wanted).drop("genres")


@query
def user_ratings(spark, folder):
    return lookup.user_ratings(ratings(spark, folder), table(spark, folder, "events"))


# Profile


@query
def rated_items(spark, folder):
    return profile.rated_items(items(spark, folder), ratings(spark, folder))


@query
def item_popularity(spark, folder):
    return profile.item_popularity(items(spark, folder), ratings(spark, folder))


@query
def popular_items(spark, folder):
    return profile.popular_items(items(spark, folder), ratings(spark, folder))


@query
def dataset_stats(spark, folder):
    return profile.dataset_stats(items(spark, folder), ratings(spark, folder))


@query
def distinct_users(spark, folder):
    return profile.distinct_users(ratings(spark, folder))


@query
def sample_popular(spark, folder):
    return sampling.sample_items(popular_items(spark, folder), n=5)


@query
def sample_items(spark, folder):
    return sampling.sample_items(items(spark, folder), n=5)


@query
def sample_fraction(spark, folder):
    pool = items(spark, folder)
    drawn = sampling.sample_fraction(pool, 0.05).distinct()
    foreign = drawn.join(pool, "item_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    n_drawn = drawn.agg(F.count(F.lit(1))).scalar()
    # six standard deviations around a twentieth
    off = F.abs(n_drawn - 0.05 * F.col("n_pool")) <= 6 * F.sqrt(0.0475 * F.col("n_pool"))
    return pool.agg(F.count(F.lit(1)).alias("n_pool")).select(
        "n_pool", (foreign == 0).alias("from_pool"), off.alias("size_ok")
    )


# Ratings and users


@query
def append_ratings(spark, folder):
    base, batch = base_and_batch(spark, folder, LATE_CUT)
    return append.append_ratings(base, batch).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("sum_rating")
    )


@query
def append_ratings_latest(spark, folder):
    base, batch = base_and_batch(spark, folder, LATE_CUT)
    return append.append_ratings(base, batch, on_conflict="latest").drop("rated_at")


@query
def append_versions(spark, folder):
    """Rows of each stored version, each read as of its batch."""
    base, batch = base_and_batch(spark, folder, LATE_CUT)
    store = Store.create(spark, fresh_path(spark, "store"))
    first, second = store.append(base, "base"), store.append(batch, "batch")
    store.append(batch, "batch")  # a replay adds nothing
    parts = [
        store.ratings(v).agg(
            F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("n"),
            F.sum("rating").alias("sum_rating"),
        )
        for v in (first, second)
    ]
    return parts[0].unionByName(parts[1])


@query
def store_latest(spark, folder):
    """A base with times, then a batch of the same pairs without times and with other ratings."""
    base = timed_ratings(spark, folder)
    store = Store.create(spark, fresh_path(spark, "store"))
    store.append(base, "base")
    again = base.filter("user_id % 3 = 0").select(
        "user_id", "item_id", (F.col("rating") / 2).alias("rating")
    )
    store.append(again, "again")
    return store.ratings(on_conflict="latest").drop("rated_at")


def three_appends(spark: SparkSession, folder: str) -> Store:
    """All ratings, then those of some users again, halved, then those of others, without times."""
    base = timed_ratings(spark, folder)
    store = Store.create(spark, fresh_path(spark, "store"))
    store.append(base, "base")
    store.item_counts()  # the list is in use before the appends
    again = base.select("user_id", "item_id", (F.col("rating") / 2).alias("rating"))
    store.append(again.filter("user_id % 3 = 0"), "again")
    store.item_counts(on_conflict="latest")
    store.append(again.filter("user_id % 5 = 0"), "other")
    return store


@query
def popular_after_appends(spark, folder):
    """Counts kept per batch and summed, beside the catalogue."""
    return profile.counted_items(items(spark, folder), three_appends(spark, folder).item_counts())


@query
def popular_latest_after_appends(spark, folder):
    """The most rated items by pairs, each counted once, from the changes of each batch."""
    counts = three_appends(spark, folder).item_counts(on_conflict="latest")
    return profile.most_rated(profile.counted_items(items(spark, folder), counts))


@query
def latest_versions(spark, folder):
    """The valid rows as of each batch."""
    store = three_appends(spark, folder)
    parts = [
        store.ratings(v, on_conflict="latest").agg(
            F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("n"),
            F.sum("rating").alias("sum_rating"),
        )
        for v in (1, 2, 3)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def stored_user_ratings(spark, folder):
    """Ratings of a few users, and of many, from the buckets of a store of two batches."""
    store = Store.create(spark, fresh_path(spark, "store"))
    for name, batch in zip(("early", "late"), base_and_batch(spark, folder, EARLY_CUT)):
        store.append(batch, name)
    few = table(spark, folder, "region").select(F.col("r_regionkey").cast("bigint").alias("user_id"))
    asked = {"few": few, "many": table(spark, folder, "events")}
    parts = [store.ratings_of(users).select(F.lit(name).alias("asked"), "user_id", "item_id", "rating") for name, users in asked.items()]
    return parts[0].unionByName(parts[1])


@query
def predict_stored(spark, folder):
    """Test rows of a store meet the user factors in their buckets."""
    early, late = base_and_batch(spark, folder, EARLY_CUT)
    store = Store.create(spark, fresh_path(spark, "store"))
    pipeline.train_pipeline(store, items(spark, folder), early, replace(PRESET_B, max_iter=1))
    store.append(late, "late")
    test = store.ratings(part="test", by_user=True)
    found = predict.predict(store.model(1), test, store.user_factors(1))
    has_prediction = F.col("prediction").isNotNull().alias("has_prediction")
    return found.select("user_id", "item_id", "rating", "status", has_prediction)


@query
def ingest_two_inboxes(spark, folder):
    """Two streams with a checkpoint each into one store, one of them twice."""
    store = Store.create(spark, fresh_path(spark, "store"))
    inbox = write_upload_files(spark, folder)
    for checkpoint in (fresh_path(spark, "stream"), fresh_path(spark, "stream")):
        ingest_uploads(store, inbox, checkpoint).awaitTermination()
    ingest_uploads(store, inbox, checkpoint).awaitTermination()
    return store.ratings().drop("rated_at")


@query
def rejected_rows(spark, folder):
    """What an upload leaves behind: reasons and counts, and what went in."""
    lines = uploads.upload_lines(uploaded_texts(spark, folder))
    store = Store.create(spark, fresh_path(spark, "store"))
    batch = store.append(uploads.parse_lines(lines, max_rating=45), "upload")
    counts = store.rejects().groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    logged = store.totals(batch)
    total = counts.agg(F.sum("n")).scalar()
    return counts.unionByName(spark.range(1).select(
        F.lit("accepted").alias("reason"),
        F.when(total == logged["n_rejected"], F.lit(logged["n_ratings"])).alias("n"),
    ))


def registry_store(spark: SparkSession, folder: str) -> Recommender:
    """A store of the early ratings under a quick model."""
    base, _ = base_and_batch(spark, folder, EARLY_CUT)
    store = Store.create(spark, fresh_path(spark, "store"))
    pipeline.train_pipeline(store, items(spark, folder), base, replace(PRESET_B, max_iter=1))
    return Recommender(store, als=replace(PRESET_B, max_iter=1))


def new_ids(allocated: DataFrame, turn: int) -> DataFrame:
    new = allocated.filter("is_new")
    return new.agg(
        F.lit(turn).alias("turn"), F.count(F.lit(1)).alias("n_new"),
        F.countDistinct("user_id").alias("n_ids"), F.min("user_id").alias("first_id"),
        F.max("user_id").alias("last_id"),
    )


@query
def allocate_twice(spark, folder):
    """The same requests twice, then a replay of the second: no id is given out again."""
    engine = registry_store(spark, folder)
    wanted = user_requests(spark, folder)
    answers = [engine.create_users(wanted, source=name) for name in ("one", "two", "two")]
    parts = [new_ids(answer, turn) for turn, answer in enumerate(answers)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def allocate_after_ingest(spark, folder):
    """Ratings appended without a refit count for who is known and which id is free."""
    engine = registry_store(spark, folder)
    _, batch = base_and_batch(spark, folder, EARLY_CUT)
    engine.store.append(batch, "late")
    return engine.create_users(user_requests(spark, folder))


@query
def known_after_merge(spark, folder):
    """Who is known after the table of users was written and ratings and an answer came since."""
    engine = registry_store(spark, folder)
    wanted = user_requests(spark, folder)
    _, batch = base_and_batch(spark, folder, EARLY_CUT)
    engine.create_users(wanted, source="one")
    engine.store.merge_users()
    engine.store.append(batch, "late")
    engine.create_users(wanted, source="two")
    return engine.known_users(wanted)


@query
def submit_replayed(spark, folder):
    """A batch of forms handed in twice: one answer, one set of rows."""
    engine = registry_store(spark, folder)
    _, batch = base_and_batch(spark, folder, EARLY_CUT)
    engine.store.append(batch, "late")
    handed_in = customer_forms(spark, folder)
    engine.submit(handed_in, "forms")
    after, summary = engine.submit(handed_in, "forms")
    added = after.store.ratings().join(
        summary.filter("is_new").select("user_id"), "user_id", "left_semi"
    ).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_stored"))
    return summary.join(added, "user_id", "left").select(
        "request_id", "user_id", "is_new", "n_rows",
        F.when(F.col("is_new"), F.coalesce("n_stored", F.lit(0))).alias("n_stored"),
    )


@query
def model_settings(spark, folder):
    """What the log tells of two fits of one batch."""
    engine = registry_store(spark, folder)
    pipeline.refit(engine.store, replace(PRESET_B, max_iter=1), on_conflict="latest")
    return engine.store.model_log().select(
        "version", "batch", "items_version", "n_ratings", "n_train", "on_conflict", "solver", "max_iter", "rank", "seed", "user_blocks",
        "item_blocks", "split_seed", "buckets", "train_buckets",
    )


@query
def known_users_range(spark, folder):
    return registry.known_users(user_requests(spark, folder), ratings(spark, folder), "range")


@query
def known_users_exists(spark, folder):
    return registry.known_users(user_requests(spark, folder), ratings(spark, folder), "exists")


@query
def allocate_users(spark, folder):
    return registry.allocate_users(user_requests(spark, folder), ratings(spark, folder), "exists")


@query
def allocate_users_range(spark, folder):
    return registry.allocate_users(user_requests(spark, folder), ratings(spark, folder), "range")


@query
def submit_ratings(spark, folder):
    handed_in = customer_forms(spark, folder)
    users = submissions.submitting_users(handed_in, ratings(spark, folder))
    return submissions.submission_summary(handed_in, users)


@query
def submitted_rows(spark, folder):
    handed_in = customer_forms(spark, folder)
    users = submissions.submitting_users(handed_in, ratings(spark, folder))
    return accepted(submissions.submitted_ratings(handed_in, users))


# Split and evaluation


@query
def split_train(spark, folder):
    return sampling.split_ratings(ratings(spark, folder))[0]


@query
def split_test(spark, folder):
    return sampling.split_ratings(ratings(spark, folder))[1]


@query
def split_stats(spark, folder):
    return sampling.split_stats(ratings(spark, folder))


@query
def split_random(spark, folder):
    train, test = sampling.split_ratings(ratings(spark, folder), method="random")
    sizes = train.select(F.lit(1).alias("in_train")).unionByName(
        test.select(F.lit(0).alias("in_train"))
    )
    share = F.avg("in_train")
    return sizes.agg(
        F.count(F.lit(1)).alias("n"), share.between(0.75, 0.85).alias("share_ok")
    )


@query
def rmse_constant_model(spark, folder):
    train, test = sampling.split_ratings(ratings(spark, folder))
    mean = train.agg(F.avg("rating")).scalar()
    score = evaluate.rmse(test.withColumn("prediction", mean))
    return score.select("n", F.round("rmse", 6).alias("rmse"))


# Model


@query
def als_factor_ids(spark, folder):
    model = fitted(spark, folder)
    sides = [
        factorize.factors(model, side).select(
            F.lit(side).alias("side"), F.col(f"{side}_id").alias("id")
        )
        for side in ("user", "item")
    ]
    return sides[0].unionByName(sides[1])


def _optimality(spark, folder, config):
    train, _ = sampling.split_ratings(ratings(spark, folder))
    return checks.optimality(fitted(spark, folder, config), train, config.reg_param)


@query
def als_optimality(spark, folder):
    return _optimality(spark, folder, PRESET_A)


@query
def als_optimality_preset_b(spark, folder):
    return _optimality(spark, folder, PRESET_B)


@query
def als_optimality_hot_keys(spark, folder):
    """The solver for hot keys, all rounds of the preset."""
    config = replace(PRESET_B, solver="grouped_sums", hot_pairs=30)
    return _optimality(spark, folder, config)


@query
def cold_start_coverage(spark, folder):
    early, late = base_and_batch(spark, folder, EARLY_CUT)
    predictions = predict.predict(factorize.fit(early), late)
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"), F.count("prediction").alias("n_scored")
    )


@query
def predict_ratings(spark, folder):
    predictions = predict.predict(fitted(spark, folder), pair_requests(spark, folder))
    has_prediction = F.col("prediction").isNotNull().alias("has_prediction")
    return predictions.select("user_id", "item_id", "status", has_prediction)


@query
def prediction_report(spark, folder):
    pairs = pair_requests(spark, folder).where(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    )
    predictions = predict.predict(fitted(spark, folder), pairs)
    # The report of each pair, beside what it must have been made from, in one pass: a pair's
    # prediction and status depend on its ids alone, so it meets each distinct title of its item.
    titles = items(spark, folder).select("item_id", "title").distinct()
    report = predict.prediction_report(predictions, titles, keep_exact=True)
    shown, exact = F.col("predicted_rating"), F.col("prediction").cast("double")
    near = F.abs(shown - exact) <= 0.00501
    rounded = F.coalesce((shown == F.round(shown, 2)) & near, F.lit(False))
    return report.select(
        "user_id", "item_id", "title", "status", rounded.alias("has_rounded_rating")
    )


@query
def predict_parity(spark, folder):
    """Test pairs whose prediction equals what MLlib's own transform gives."""
    model = fitted(spark, folder)
    _, test = sampling.split_ratings(ratings(spark, folder))
    ours = predict.predict(model, test).groupBy("user_id", "item_id").agg(
        F.max("prediction").alias("ours")
    )
    pairs = test.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"))
    theirs = model.transform(pairs).groupBy("user_id", "item_id").agg(
        F.max("prediction").alias("theirs")
    )
    close = F.abs(F.col("ours") - F.col("theirs")) < 1e-4
    return ours.join(theirs, ["user_id", "item_id"]).select(
        F.col("user_id").cast("bigint"), F.col("item_id").cast("bigint"), close.alias("same")
    )


def evaluate_model(spark, folder):
    model = fitted(spark, folder)
    _, test = sampling.split_ratings(ratings(spark, folder))
    score = evaluate.rmse(predict.predict(model, test))
    evaluator = RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    )
    expected = evaluator.evaluate(model.transform(test))
    matches = F.abs(F.col("rmse") - expected) < 1e-6
    return score.select("n", matches.alias("rmse_matches"))


QUERIES["evaluate"] = evaluate_model


# Top-N


@query
def recommend_top_n(spark, folder):
    model = fitted(spark, folder)
    # written once: the checks read the lists several times
    lists = stage(topn.recommend(model, TOP_N), fresh_path(spark, "lists"))
    best = checks.nothing_better(model, lists, TOP_N).drop("n_rows")
    return checks.list_shape(lists).join(best, "user_id")


@query
def recommend_titles(spark, folder):
    lists = recommendation_lists(spark, folder)
    known = items(spark, folder).withColumnRenamed("title", "expected")
    checked = lists.join(known, "item_id", "left")
    return checked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("title").eqNullSafe(F.col("expected"))).alias("titles_ok"),
    )


@query
def recommend_subset_users(spark, folder):
    """Lists of some users, each row beside that of the lists of all users."""
    model = fitted(spark, folder)
    lists = topn.recommend(model, TOP_N, user_list(spark, folder))
    full = topn.recommend(model, TOP_N).select("user_id", "rank", F.col("score").alias("expected"))
    same = F.coalesce(F.abs(F.col("score") - F.col("expected")) < 1e-5, F.lit(False))
    return lists.join(full, ["user_id", "rank"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(same).alias("same")
    )


@query
def recommend_unseen(spark, folder):
    rows = ratings(spark, folder)
    model = fitted(spark, folder)
    lists = stage(topn.recommend_unseen(model, TOP_N, rows), fresh_path(spark, "lists"))
    return checks.nothing_better(model, lists, TOP_N, rows.select("user_id", "item_id").distinct())


# Composed jobs


@query
def refit_after_append(spark, folder):
    base, batch = base_and_batch(spark, folder, EARLY_CUT)
    store = Store.create(spark, fresh_path(spark, "store"))
    first = pipeline.train_pipeline(store, items(spark, folder), base).first().version
    second = pipeline.add_ratings(store, batch, source="batch").first().version
    old, new = store.model(first), store.model(second)
    users = profile.distinct_users(store.ratings())
    for name, model in (("in_old_model", old), ("in_new_model", new)):
        trained = factorize.factors(model, "user").select("user_id", F.lit(True).alias("_in"))
        users = users.join(trained, "user_id", "left").withColumn(
            name, F.coalesce("_in", F.lit(False))
        ).drop("_in")
    return users


@query
def pipeline_summary(spark, folder):
    items_csv, ratings_csv = fresh_path(spark, "items-csv"), fresh_path(spark, "ratings-csv")
    csv_tables.write_csv(items(spark, folder), items_csv)
    csv_tables.write_csv(ratings(spark, folder).withColumn("timestamp", F.lit(0)), ratings_csv)
    store = Store.create(spark, fresh_path(spark, "store"))
    summary = pipeline.train_pipeline(
        store, csv_tables.read_items(spark, items_csv), csv_tables.read_ratings(spark, ratings_csv)
    )
    n_items = store.items().agg(F.count(F.lit(1))).scalar()
    finite = F.col("rmse").isNotNull() & ~F.isnan("rmse")
    return summary.select(
        n_items.alias("n_items"), "n_ratings", "max_user_id", "n_train", "n_test",
        finite.alias("rmse_is_finite"),
    )
