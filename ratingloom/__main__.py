"""Batch jobs: ``spark-submit ratingloom/__main__.py <job> --store DIR ...``

Requests come as CSV with a header line, answers go out as JSON lines, one folder per job.
Requests that are not valid are written next to the answers, under ``rejects``.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom import schemas
from ratingloom.config import PRESET_A, PRESET_B, SAMPLE_SEED
from ratingloom.operators.lookup import validate_requests
from ratingloom.operators.registry import repeated_requests
from ratingloom.plans import pipeline
from ratingloom.plans.recommender import Recommender
from ratingloom.plans.store import Store
from ratingloom.sources import accepted, rejected, write_json_records
from ratingloom.streaming.uploads import ingest_uploads

PRESETS = {"A": PRESET_A, "B": PRESET_B}


def positive(text: str) -> int:
    if int(text) <= 0:
        raise argparse.ArgumentTypeError("must be above zero")
    return int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ratingloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, help: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        sub.add_argument("--store", required=True)
        sub.add_argument("--preset", choices=PRESETS, default="A")
        sub.add_argument("--max-iter", type=positive, help="instead of the preset's")
        sub.add_argument("--reg-param", type=float, help="instead of the preset's")
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    job("train", "load two CSV files and train", "items", "ratings")
    latest = job("refit", "train again on all ratings appended so far")
    latest.add_argument("--on-conflict", choices=("keep", "latest"), default="keep")
    job("items", "look up items by item_id", "requests", "out")
    sample = job("sample", "random items to rate", "out")
    sample.add_argument("--n", type=positive, default=1)
    sample.add_argument("--seed", type=int, default=SAMPLE_SEED)
    sample.add_argument("--pool", choices=("popular", "all"), default="popular")
    job("user-ratings", "ratings of the users in a list of user_id", "requests", "out")
    for name in ("known-users", "create-users"):
        users = job(name, "for request_id, user_id", "requests", "out")
        users.add_argument("--mode", choices=("exists", "range"), default="exists")
    users.add_argument("--source", help="a name under which a replay gets the same answer")
    job("predict", "ratings for user_id, item_id pairs", "requests", "out")
    recommend = job("recommend", "ranked items for a list of user_id, or for all users", "out")
    recommend.add_argument("--n", type=positive, default=10)
    recommend.add_argument("--requests")
    recommend.add_argument("--exclude-seen", action="store_true")
    for name, help, *options in (
        ("upload", "add rating files under DIR/user_id=<id>/ and refit", "files", "source"),
        ("ingest", "append the files waiting in an inbox, without a refit", "files", "checkpoint"),
    ):
        files = job(name, help, *options)
        files.add_argument("--min-rating", type=float)
        files.add_argument("--max-rating", type=float)
        if name == "upload":
            files.add_argument("--on-conflict", choices=("keep", "latest"), default="keep")
    forms = job("submit", "add forms (JSON lines: request_id, user_id, fields) and refit", "forms",
                "source", "out")
    forms.add_argument("--on-conflict", choices=("keep", "latest"), default="keep")
    job("rejects", "rows refused so far, with their reasons", "out")
    return top


def read_requests(
    spark: SparkSession, args: argparse.Namespace, numeric: list[str], optional: list[str] = ()
) -> DataFrame:
    """The valid requests. The others are written out as they came."""
    columns = [*numeric, *optional]
    schema = ", ".join(f"{c} string" for c in columns)
    options = {"header": True, "enforceSchema": False}  # a header in another order is an error
    raw = spark.read.schema(schema).options(**options).csv(args.requests)
    copies = raw.withColumn("request", F.struct(*columns))
    checked = validate_requests(copies, numeric, optional=optional)
    if "request_id" in numeric:
        repeats = repeated_requests(accepted(checked)).select("request_id", F.lit("repeated_request_id").alias("_r"))
        checked = checked.join(repeats, "request_id", "left").withColumn("reason", F.coalesce("reason", "_r")).drop("_r")
    write_json_records(rejected(checked).select("request", "reason"), f"{args.out}/rejects")
    return accepted(checked).select(*columns)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Do one job. Returns its answer, or the log row of what it wrote."""
    own = {"max_iter": args.max_iter, "reg_param": args.reg_param}
    als = replace(PRESETS[args.preset], **{k: v for k, v in own.items() if v is not None})
    if args.job == "train":
        engine = Recommender.train(spark, args.store, args.items, args.ratings, als)
        return engine.log()
    if args.job == "refit":
        return pipeline.refit(Store(spark, args.store), als, args.on_conflict)
    if args.job == "ingest":
        store = Store(spark, args.store)
        limits = {"min_rating": args.min_rating, "max_rating": args.max_rating}
        ingest_uploads(store, args.files, args.checkpoint, **limits).awaitTermination()
        return store.rating_log()

    engine = Recommender(Store(spark, args.store), als=als)
    if args.job == "upload":
        limits = {"min_rating": args.min_rating, "max_rating": args.max_rating}
        options = {**limits, "on_conflict": args.on_conflict}
        return engine.upload(args.files, args.source, **options).log()
    if args.job == "submit":
        schema = T.StructType([
            *schemas.USER_REQUESTS.fields, T.StructField("fields", schemas.FORM_FIELDS)
        ])
        forms = spark.read.schema(schema).json(args.forms)
        answer = engine.submit(forms, args.source, on_conflict=args.on_conflict)[1]
    elif args.job == "rejects":
        answer = engine.store.rejects()
    elif args.job == "sample":
        answer = engine.sample_items(args.n, args.seed, args.pool)
    elif args.job == "items":
        answer = engine.find_items(read_requests(spark, args, ["item_id"]))
    elif args.job == "user-ratings":
        answer = engine.ratings_for(read_requests(spark, args, ["user_id"]))
    elif args.job == "known-users":
        users = read_requests(spark, args, ["request_id"], optional=["user_id"])
        answer = engine.known_users(users, args.mode)
    elif args.job == "create-users":
        users = read_requests(spark, args, ["request_id"], optional=["user_id"])
        answer = engine.create_users(users, args.mode, args.source)
    elif args.job == "predict":
        answer = engine.report(read_requests(spark, args, ["user_id", "item_id"]))
    else:
        users = read_requests(spark, args, ["user_id"]) if args.requests else None
        answer = engine.recommend(args.n, users, args.exclude_seen)
    path = f"{args.out}/answers"
    write_json_records(answer, path)
    return spark.read.schema(answer.schema).json(path)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ratingloom-{args.job}").getOrCreate()
    run(spark, args).show(truncate=False)


if __name__ == "__main__":
    main()
