"""Fitting the factor model."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.config import ID_MAX, ID_MIN, AlsConfig
from ratingloom.operators.normal_equations import alternate
from ratingloom.operators.profile import hottest_keys
from ratingloom.sources.rejects import accepted, check_ratings
from ratingloom.sources.staging import stage
from ratingloom.workspace import fresh_path, shared_dir


def usable_ratings(ratings: DataFrame) -> DataFrame:
    """The rows ALS can take, with ids narrowed to int only here."""
    return accepted(check_ratings(ratings)).select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), F.col("rating")
    )


def fit(train: DataFrame, config: AlsConfig = AlsConfig(), n_rows: int | None = None) -> ALSModel:
    """Explicit-feedback ALS; repeated (user, item) rows each weigh in.

    The settings alone choose the solver. ``n_rows`` saves a count.
    """
    if config.solver == "grouped_sums":
        return fit_by_sums(usable_ratings(train), config)
    if config.solver != "mllib":
        raise ValueError(f"unknown solver {config.solver!r}")
    check_blocks(train, config, train.count() if n_rows is None else n_rows)
    shared_dir(train.sparkSession)  # where long fits cut their lineage
    return estimator(config).fit(usable_ratings(train))


def check_blocks(train: DataFrame, config: AlsConfig, n_rows: int) -> None:
    """Refuse a fit whose ratings MLlib's blocks can't hold. A key has at most all rows, so the
    largest one is looked for only where it could be too large."""
    most = config.max_rows_per_block
    average = n_rows / min(config.user_blocks, config.item_blocks)
    if average > most:
        raise ValueError(
            f"{n_rows} ratings make blocks of {average:.0f} rows on average, above "
            f"max_rows_per_block={most}: raise user_blocks and item_blocks"
        )
    if n_rows > most:
        largest = max(hottest_keys(train).first())
        if largest > most:
            raise ValueError(
                f"one user or item has {largest} ratings, above max_rows_per_block={most}: "
                "set solver='grouped_sums'"
            )


def estimator(config: AlsConfig) -> ALS:
    return ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        rank=config.rank,
        maxIter=config.max_iter,
        regParam=config.reg_param,
        seed=config.seed,
        numUserBlocks=config.user_blocks,
        numItemBlocks=config.item_blocks,
        implicitPrefs=False,
        nonnegative=False,
        checkpointInterval=config.checkpoint_interval,
        coldStartStrategy="drop",
    )


def fit_by_sums(ratings: DataFrame, config: AlsConfig) -> ALSModel:
    """ALS for ratings of which one user or item may hold a large share, as an explicit choice.

    The model is stored in MLlib's format around a fit of a single rating, so that it loads and
    scores like any other.
    """
    spark = ratings.sparkSession
    users, items = alternate(ratings, config)
    path = fresh_path(spark, "model")
    # of written ids: the ratings' own first row may take all their joins
    one = users.select("user_id").limit(1).crossJoin(items.select("item_id").limit(1))
    save_model(estimator(config).fit(one.withColumn("rating", F.lit(1.0))), path)
    for name, table, key in (("userFactors", users, "user_id"), ("itemFactors", items, "item_id")):
        stage(table.select(F.col(key).alias("id"), "features"), f"{path}/{name}")
    return load_model(path)


def factors(model: ALSModel, side: str) -> DataFrame:
    """``<side>_id, <side>_factor`` of one side, 'user' or 'item', with the id widened again."""
    table = model.userFactors if side == "user" else model.itemFactors
    return table.select(
        F.col("id").cast("bigint").alias(f"{side}_id"), F.col("features").alias(f"{side}_factor")
    )


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def fits_id_range(column: str):
    return F.col(column).between(ID_MIN, ID_MAX)
